"""DuckDB SQL of the queries that SQL can express (brute force, for checking)."""

from __future__ import annotations

from farelake.llm import licenses, merkle, ranked_search, secrets, templates
from farelake.plans.sql import values_relation, with_steps

UPPER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"


def quoted(text: str) -> str:
    return "'" + text.replace("'", "''") + "'"


# --- 2: line templates ----------------------------------------------------------------

TEMPLATE_STEPS = [
    ("docs", "SELECT doc_id, text, string_split(text, chr(10)) AS lines FROM documents"),
    ("cut", "SELECT doc_id, unnest(lines) AS line, unnest(range(0, len(lines))) AS line_no FROM docs WHERE doc_id IS NOT NULL"),
    ("raw", f"SELECT doc_id, line_no, list_filter(string_split_regex(line, {quoted(templates.SPACE)}), lambda x: x <> '') AS words FROM cut"),
    ("masked", f"SELECT doc_id, line_no, list_transform(words, lambda x: CASE WHEN regexp_matches(x, {quoted(templates.VARIABLE)}) "
               f"THEN '{templates.WILD}' ELSE x END) AS t FROM raw WHERE len(words) > 0"),
    ("kind", "SELECT t, len(t) AS n, row_number() OVER () AS id FROM (SELECT DISTINCT t FROM masked)"),
    ("link", f"SELECT a.id AS a, b.id AS b FROM kind a JOIN kind b ON a.n = b.n AND a.t[1:{templates.DEPTH}] = b.t[1:{templates.DEPTH}] AND a.id <> b.id "
             f"WHERE list_sum(list_transform(list_zip(a.t, b.t), lambda x: (x[1] = x[2])::INT)) >= ceil(a.n * {templates.MIN_CONSTANT})"),
    ("reach(id, other)", "SELECT id, id FROM kind UNION SELECT r.id, link.b FROM reach r JOIN link ON r.other = link.a"),
    ("template", "SELECT doc_id, line_no, g FROM masked JOIN kind USING (t) JOIN (SELECT id, min(other) AS g FROM reach GROUP BY id) USING (id)"),
    ("recurring", "SELECT g, min(doc_id) AS first FROM template GROUP BY g HAVING min(doc_id) < max(doc_id)"),
    ("gone", "SELECT doc_id, list(line_no) AS gone FROM template JOIN recurring USING (g) WHERE doc_id <> first GROUP BY doc_id"),
]

TEMPLATES = with_steps(
    TEMPLATE_STEPS,
    "SELECT d.doc_id, coalesce(len(lines), 0)::BIGINT AS n_lines, coalesce(len(gone), 0)::BIGINT AS n_dropped, "
    "sha256(coalesce(array_to_string(list_transform(list_filter(range(0, len(lines)), "
    "lambda i: NOT coalesce(list_contains(gone, i), false)), lambda i: lines[i + 1]), chr(10)), '')) AS text_sha256 "
    "FROM docs d LEFT JOIN gone g ON d.doc_id = g.doc_id",
).replace("WITH ", "WITH RECURSIVE ", 1)

# --- 3: vectors ----------------------------------------------------------------------------

VECTORS = """
WITH RECURSIVE u AS (
  SELECT vec_id, label, embedding::DOUBLE[] AS e FROM embeddings
  WHERE vec_id IS NOT NULL AND label IS NOT NULL AND len(embedding) > 0
    AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0
    AND len(list_filter(embedding, lambda x: x <> 0)) > 0),
link AS (
  SELECT a.vec_id AS a, b.vec_id AS b FROM u a JOIN u b
  ON a.label = b.label AND len(a.e) = len(b.e) AND a.vec_id <> b.vec_id
  WHERE list_dot_product(a.e, b.e) / sqrt(list_dot_product(a.e, a.e) * list_dot_product(b.e, b.e)) >= 0.93),
reach(vec_id, other) AS (
  SELECT vec_id, vec_id FROM embeddings UNION SELECT r.vec_id, link.b FROM reach r JOIN link ON r.other = link.a),
low AS (SELECT vec_id, min(other) AS component_id FROM reach GROUP BY vec_id),
degree AS (SELECT a, count(*) AS n FROM link GROUP BY a)
SELECT v.vec_id, coalesce(d.n, 0)::BIGINT AS n_links, l.component_id, v.vec_id = l.component_id AS kept
FROM embeddings v JOIN low l USING (vec_id) LEFT JOIN degree d ON d.a = v.vec_id
"""

# --- 4: licences -----------------------------------------------------------------------------

_POSTINGS = [
    (t, label, p, w) for t, (label, body, _) in enumerate(licenses.TEMPLATES) for p, w in enumerate(body.split())
]
_PHRASES = [
    (t, " ".join(body.split()).split(phrase)[0].count(" ") + k, w)
    for t, (_, body, phrase) in enumerate(licenses.TEMPLATES)
    for k, w in enumerate(phrase.split())
]
_BASE = [(phrase, label, len(phrase.split())) for phrase, label in licenses.BASE.items()]

LICENSE_STEPS = [
    ("posting", "SELECT * FROM " + values_relation(_POSTINGS, ["t", "label", "p", "w"])),
    ("phrase", "SELECT * FROM " + values_relation(_PHRASES, ["t", "q", "w"])),
    ("base", "SELECT * FROM " + values_relation(_BASE, ["phrase", "label", "k"])),
    ("ws", f"SELECT doc_id, list_filter(string_split_regex(translate(coalesce(text, ''), '{UPPER}', '{UPPER.lower()}'), "
           f"{quoted(licenses.SEPARATORS)}), lambda x: x <> '') AS ws FROM documents"),
    ("word", "SELECT doc_id, unnest(ws) AS w, unnest(range(0, len(ws))) AS i FROM ws"),
    ("place", "SELECT DISTINCT s.doc_id, s.i, b.label FROM word s JOIN ws USING (doc_id) JOIN base b "
              "ON s.w = string_split(b.phrase, ' ')[1] AND array_to_string(ws.ws[s.i + 1:s.i + b.k], ' ') = b.phrase"),
    ("idf", "SELECT v.w, ln((SELECT count(*) + 1 FROM documents) / (count(DISTINCT s.doc_id) + 1)) AS idf "
            "FROM (SELECT DISTINCT w FROM posting) v LEFT JOIN word s USING (w) GROUP BY v.w"),
    ("anchor", f"SELECT t, w FROM (SELECT DISTINCT t, w FROM phrase) JOIN idf USING (w) "
               f"QUALIFY row_number() OVER (PARTITION BY t ORDER BY idf DESC, w) <= {licenses.MIN_AGREE}"),
    ("indexed", f"SELECT DISTINCT p.t, p.w, greatest(idf, {licenses.LEAST_IDF}) AS idf FROM posting p JOIN idf USING (w) "
                f"WHERE idf >= ln(1 / {licenses.RARE_SHARE}) OR EXISTS (SELECT 1 FROM anchor a WHERE a.t = p.t AND a.w = p.w)"),
    ("total", "SELECT t, sum(idf) AS weight FROM indexed GROUP BY t"),
    ("agree", "SELECT DISTINCT s.doc_id, p.t, s.i - p.p AS o, p.w, x.idf FROM word s JOIN posting p USING (w) JOIN indexed x ON x.t = p.t AND x.w = p.w"),
    ("cand", "SELECT doc_id, t, o, sum(idf) / any_value(weight) AS coverage FROM agree JOIN total USING (t) GROUP BY doc_id, t, o"),
    ("match", "SELECT c.doc_id, c.t, c.o, any_value(c.coverage) AS coverage FROM cand c JOIN phrase q USING (t) "
              "LEFT JOIN word s ON s.doc_id = c.doc_id AND s.i = c.o + q.q AND s.w = q.w GROUP BY c.doc_id, c.t, c.o HAVING count(*) = count(s.w)"),
    ("added", "SELECT doc_id, list(DISTINCT label) AS labels, max(coverage) AS best FROM match JOIN (SELECT DISTINCT t, label FROM posting) USING (t) GROUP BY doc_id"),
    ("found", "SELECT doc_id, count(*) AS n, min(i) AS lo, max(i) AS hi, list(DISTINCT label) AS labels FROM place GROUP BY doc_id"),
]

LICENSES = with_steps(
    LICENSE_STEPS,
    "SELECT ws.doc_id, len(ws)::BIGINT AS n_words, coalesce(f.n, 0)::BIGINT AS n_base, f.lo::BIGINT AS first_word, "
    "f.hi::BIGINT AS last_word, coalesce(array_to_string(list_sort(f.labels), ','), '') AS base_labels, "
    "coalesce(array_to_string(list_sort(list_distinct(list_concat(coalesce(f.labels, []), coalesce(a.labels, [])))), ','), '') AS labels, "
    "CASE WHEN f.n > 0 THEN 1.0 ELSE round(least(coalesce(a.best, 0.0), 1.0), 9) END::DOUBLE AS score "
    "FROM ws LEFT JOIN found f USING (doc_id) LEFT JOIN added a USING (doc_id)",
)

# --- 10: secrets ------------------------------------------------------------------------------


def _matches(kind: str, pattern: str, group: int = 0) -> str:
    p = quoted(pattern)
    return (
        f"SELECT doc_id, '{kind}' AS kind, unnest(regexp_extract_all(body, {p})) AS found, "
        f"unnest(regexp_extract_all(body, {p}, {group})) AS part, unnest(string_split_regex(body, {p})[:-2]) AS gap, "
        f"unnest(range(0, len(regexp_extract_all(body, {p})))) AS k FROM body"
    )


SECRET_STEPS = [
    ("body", "SELECT doc_id, coalesce(text, '') AS body FROM documents"),
    ("every", " UNION ALL ".join([
        _matches("assign", secrets.ASSIGN, 2), _matches("access", secrets.ACCESS),
        _matches("hex", secrets.HEX), _matches("entropy", secrets.CANDIDATE)])),
    ("span", "SELECT *, ends - length(found) AS starts FROM (SELECT *, sum(length(gap) + length(found)) OVER "
             "(PARTITION BY doc_id, kind ORDER BY k) AS ends FROM every)"),
    ("base", f"SELECT doc_id, kind, starts, ends FROM span WHERE kind IN ('access', 'hex') OR kind = 'assign' AND length(part) >= {secrets.ASSIGN_MIN}"),
    ("cand", f"SELECT doc_id, starts, ends, least({secrets.WINDOW}, length(found)) AS size, array_to_string(list_transform("
             f"string_split_regex(found, '[/=]'), lambda x: CASE WHEN regexp_matches(x, {quoted(secrets.ALLOW)}) THEN repeat(' ', length(x)) ELSE x END), '/') AS run "
             "FROM span s WHERE kind = 'entropy' AND regexp_matches(found, '[0-9]') AND regexp_matches(found, '[A-Za-z]') "
             f"AND NOT regexp_matches(found, {quoted(secrets.NAME)}) "
             "AND NOT EXISTS (SELECT 1 FROM base b WHERE b.doc_id = s.doc_id AND b.starts < s.ends AND b.ends > s.starts)"),
    ("win", "SELECT doc_id, starts, ends, size, w, substring(run, w::INTEGER, size::INTEGER) AS part FROM "
            "(SELECT *, unnest(range(1, length(run) - size + 2)) AS w FROM cand)"),
    ("chars", "SELECT *, unnest(string_split(part, '')) AS c FROM win WHERE NOT contains(part, ' ') "
              "AND regexp_matches(part, '[0-9]') AND regexp_matches(part, '[A-Za-z]')"),
    ("counts", "SELECT doc_id, starts, ends, size, w, part, c, count(*) AS n FROM chars GROUP BY ALL"),
    ("bits", "SELECT doc_id, starts, ends, size, w, part, -sum(n / size * log2(n / size)) AS h FROM counts GROUP BY ALL"),
    ("extra", "SELECT DISTINCT doc_id, 'entropy' AS kind, starts, ends FROM bits WHERE h >= CASE "
              + " ".join(f"WHEN regexp_matches(part, {quoted(p)}) THEN {low} + (size - {secrets.SHORTEST}) * {(high - low) / (secrets.WINDOW - secrets.SHORTEST)}"
                         for _, p, low, high in secrets.CLASSES) + " END"),
]
_RANK = "list_position(['assign', 'access', 'hex', 'entropy'], kind)"
_JOINED = f"string_agg(kind || ':' || starts::BIGINT || ':' || ends::BIGINT, ',' ORDER BY starts, {_RANK})"
SECRET_STEPS.append((
    "listed",
    f"SELECT doc_id, {_JOINED} FILTER (kind <> 'entropy') AS base, {_JOINED} AS spans, "
    "count(*) FILTER (kind = 'assign') AS a, count(*) FILTER (kind = 'access') AS k, count(*) FILTER (kind = 'hex') AS h, "
    "count(*) FILTER (kind = 'entropy') AS e FROM (SELECT * FROM base UNION ALL SELECT * FROM extra) GROUP BY doc_id",
))

SECRETS = with_steps(
    SECRET_STEPS,
    "SELECT doc_id, coalesce(a, 0)::BIGINT AS n_assign, coalesce(k, 0)::BIGINT AS n_access, coalesce(h, 0)::BIGINT AS n_hex, "
    "sha256(coalesce(base, '')) AS base_sha256, coalesce(spans, '') AS spans, coalesce(e, 0)::BIGINT AS n_entropy "
    "FROM body LEFT JOIN listed USING (doc_id)",
)


# --- 11: ranked search -------------------------------------------------------------------

def _terms(table: str, key: str) -> str:
    lower = f"translate(coalesce(text, ''), '{UPPER}', '{UPPER.lower()}')"
    return (
        f"SELECT row_number() OVER () AS rid, {key}, list_filter(string_split_regex({lower}, "
        f"{quoted(ranked_search.SEPARATORS)}), lambda x: x <> '') AS t FROM {table}"
    )


SEARCH_STEPS = [
    ("d", _terms("documents", "doc_id")),
    ("q", _terms("benchmark", "item_id")),
    ("size", "SELECT count(*) FILTER (WHERE len(t) > 0)::BIGINT AS n, sum(len(t))::BIGINT AS l FROM d"),
    ("wanted", "SELECT item_id, term, count(*) AS times FROM (SELECT item_id, unnest(t) AS term FROM q) GROUP BY ALL"),
    ("tf", "SELECT rid, doc_id, n, term, count(*) AS tf FROM (SELECT rid, doc_id, len(t) AS n, unnest(t) AS term FROM d) "
           "WHERE term IN (SELECT term FROM wanted) GROUP BY ALL"),
    ("weight", "SELECT term, floor(1000 * ln((2 * size.n + 2)::DOUBLE / (2 * df + 1)))::BIGINT AS w "
               "FROM (SELECT term, count(*) AS df FROM tf GROUP BY term), size"),
    ("gain", "SELECT rid, doc_id, term, (1000000000 * tf) // (1000 * tf + 12 * (75 + (25 * tf.n * size.n) // size.l)) AS g FROM tf, size"),
    ("scored", "SELECT item_id, rid, doc_id, sum(times * w * g)::BIGINT AS score FROM wanted JOIN weight USING (term) "
               "JOIN gain USING (term) GROUP BY ALL HAVING sum(times * w * g) > 0"),
    ("placed", "SELECT item_id, row_number() OVER (PARTITION BY item_id ORDER BY score DESC, doc_id)::INT AS rank, doc_id, score FROM scored"),
]

SEARCH = with_steps(SEARCH_STEPS, f"SELECT item_id, rank, doc_id, score FROM placed WHERE rank <= {ranked_search.TOP}")


# --- 13: Merkle manifest -----------------------------------------------------------------

def _encoded(value: str) -> str:
    return f"coalesce(strlen(({value})::VARCHAR) || ':' || ({value})::VARCHAR, '-')"


def _tree(source: str, group: str, levels: int) -> tuple[list[tuple[str, str]], str]:
    """Steps that build the trees over ``source`` (grp, pos, h, n); the sides of every node are in ``{group}_side_k``."""
    steps = [(f"{group}_0", f"SELECT grp, pos, h, n FROM {source}")]
    for k in range(levels):
        run = "PARTITION BY grp, pos // 16 ORDER BY pos ROWS BETWEEN"
        steps += [
            (f"{group}_side_{k}", f"SELECT grp, pos, n, coalesce(string_agg(h, '') OVER ({run} UNBOUNDED PRECEDING AND 1 PRECEDING), '') AS l, "
                                  f"coalesce(string_agg(h, '') OVER ({run} 1 FOLLOWING AND UNBOUNDED FOLLOWING), '') AS r FROM {group}_{k}"),
            (f"{group}_{k + 1}", f"SELECT grp, pos // 16 AS pos, CASE WHEN n = 1 THEN any_value(h) ELSE sha256(string_agg(h, '' ORDER BY pos)) END AS h, "
                                 f"(n + 15) // 16 AS n FROM {group}_{k} GROUP BY grp, pos // 16, n"),
        ]
    return steps, f"{group}_{levels}"


def _folds(start: str, group: str, levels: int, place: str) -> tuple[list[tuple[str, str]], str]:
    """Steps that fold ``cur`` and lengthen ``proof`` of ``start`` along the tree."""
    steps, last = [], start
    for k in range(levels):
        steps.append((f"{start}_{group}_{k}", (
            f"SELECT f.* REPLACE (CASE WHEN s.n > 1 THEN sha256(s.l || cur || s.r) ELSE cur END AS cur, proof || s.l || s.r AS proof) "
            f"FROM {last} f JOIN {group}_side_{k} s ON s.grp IS NOT DISTINCT FROM f.{'grp' if place == 'pos' else 'one'} AND s.pos = f.{place} // {16**k}"
        )))
        last = f"{start}_{group}_{k}"
    return steps, last


#: levels of a source (65,536 rows) and of the sources (4,096) that the twin can hold
_LOW, _TOP = 4, 3
_CRC = (
    "xor(list_reduce(list_prepend(4294967295::BIGINT, flatten(list_transform(string_split(doc_id::VARCHAR, ''), "
    "lambda x: [ord(x)::BIGINT, -1, -1, -1, -1, -1, -1, -1, -1]))), lambda c, o: CASE WHEN o >= 0 THEN xor(c, o) "
    "WHEN c & 1 = 1 THEN xor(c >> 1, 3988292384) ELSE c >> 1 END), 4294967295)"
)
_FIELDS = [_encoded(c) for c in merkle.FIELDS]
_CHANGED = [_encoded(f"translate(text, '{UPPER}', '{UPPER.lower()}')") if c == "text" else _encoded(c) for c in merkle.FIELDS]
_low_steps, _subroots = _tree("leaves", "low", _LOW)
_top_steps, _roots = _tree("subs", "top", _TOP)
_fold_low, _folded_low = _folds("f", "low", _LOW, "pos")
_fold_top, _folded_top = _folds(_folded_low, "top", _TOP, "rank")
MERKLE = with_steps(
    [
        ("hashed", f"SELECT doc_id, source AS grp, sha256({' || '.join(_FIELDS)}) AS h, "
                   f"CASE WHEN text IS NOT NULL AND {_CRC} % 5 = 0 THEN sha256({' || '.join(_CHANGED)}) END AS changed FROM documents"),
        ("leaves", "SELECT *, row_number() OVER (PARTITION BY grp ORDER BY doc_id NULLS FIRST, h) - 1 AS pos, count(*) OVER (PARTITION BY grp) AS n FROM hashed"),
        *_low_steps,
        ("subs", f"SELECT 0 AS grp, grp AS source, h, row_number() OVER (ORDER BY grp NULLS FIRST) - 1 AS pos, count(*) OVER () AS n FROM {_subroots}"),
        *_top_steps,
        ("f", "SELECT l.*, s.h AS subroot, s.pos AS rank, 0 AS one, coalesce(changed, l.h) AS cur, '' AS proof "
              "FROM leaves l JOIN subs s ON s.source IS NOT DISTINCT FROM l.grp"),
        *_fold_low,
        *_fold_top,
    ],
    f"SELECT doc_id, f.h AS leaf, subroot, r.h AS root, sha256(proof) AS proof_sha256, cur AS folded_root, cur = r.h AS verified "
    f"FROM {_folded_top} f, {_roots} r",
)


def oracle_sql() -> dict[str, str]:
    """Query name → SQL over ``documents``, ``embeddings`` and ``benchmark``."""
    return {
        "op2_log_templates": TEMPLATES,
        "op3_metric_range_join": VECTORS,
        "op4_license_scan": LICENSES,
        "op10_secret_scan": SECRETS,
        "op11_ranked_search": SEARCH,
        "op13_merkle_manifest": MERKLE,
    }
