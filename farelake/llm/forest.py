"""Merging of links into component labels inside one group (numpy)."""

from __future__ import annotations

import numpy as np


def merge_labels(label: np.ndarray, a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Labels after the links ``a[i]``-``b[i]`` are added: the smallest index of each component.

    ``label`` maps every index to a label that labels itself.
    """
    while True:
        la, lb = label[a], label[b]
        low = np.minimum(la, lb)
        if np.array_equal(la, lb):
            return label
        np.minimum.at(label, la, low)
        np.minimum.at(label, lb, low)
        while not np.array_equal(label, label[label]):
            label = label[label]
