"""DuckDB SQL of the corpus operators that SQL can express."""

from __future__ import annotations

import pyarrow as pa

from . import decontam, jaccard, kernels, license

#: Words as the kernels cut them.
WORD = r"'[0-9a-zªµºÀ-\x{1fff}\x{2080}-\x{10ffff}]+'"


def words(text: str) -> str:
    return f"regexp_extract_all(lower({text}), {WORD})"


def quoted(s: str) -> str:
    return "'" + s.replace("'", "''") + "'"


TOPK = f"""
    WITH d AS (SELECT row_number() OVER () AS r, doc_id, {words("text")} AS w FROM documents WHERE doc_id IS NOT NULL AND text IS NOT NULL),
    stats AS (SELECT count(*)::DOUBLE AS n, sum(len(w))::DOUBLE / count(*) AS mean FROM d WHERE len(w) > 0),
    q AS (SELECT DISTINCT r, query_id, t FROM (
        SELECT row_number() OVER () AS r, item_id AS query_id, unnest({words("text")}) AS t FROM benchmark WHERE item_id IS NOT NULL AND text IS NOT NULL)),
    tf AS (SELECT r, doc_id, n_words, t, count(*)::DOUBLE AS c FROM (SELECT r, doc_id, len(w)::DOUBLE AS n_words, unnest(w) AS t FROM d) WHERE t IN (SELECT t FROM q) GROUP BY ALL),
    idf AS (SELECT t, ln(1 + (n - df + 0.5::DOUBLE) / (df + 0.5::DOUBLE)) AS idf FROM (SELECT t, count(*)::DOUBLE AS df FROM tf GROUP BY t), stats),
    impact AS (SELECT r, doc_id, t, floor(idf * c * (1.2::DOUBLE + 1) / (c + 1.2::DOUBLE * ((1 - 0.75::DOUBLE) + 0.75::DOUBLE * n_words / mean)) * 1e6::DOUBLE + 0.5::DOUBLE)::BIGINT AS i
        FROM tf JOIN idf USING (t), stats),
    total AS (SELECT q.r AS query_row, query_id, impact.r, doc_id, sum(i)::BIGINT AS s FROM q JOIN impact USING (t) GROUP BY ALL),
    ranked AS (SELECT *, row_number() OVER (PARTITION BY query_row ORDER BY s DESC, doc_id) AS rank FROM total)
    SELECT query_id, rank, doc_id, s / 1e6::DOUBLE AS score FROM ranked WHERE rank <= 10"""

JACCARD = f"""
    WITH RECURSIVE words AS (SELECT doc_id, min({words("text")}) AS w FROM documents GROUP BY doc_id),
    grams AS (
        SELECT DISTINCT doc_id, unnest(CASE WHEN len(w) < 3 THEN [array_to_string(w, ' ')]
            ELSE [w[i] || ' ' || w[i + 1] || ' ' || w[i + 2] FOR i IN range(1, len(w) - 1)] END) AS g
        FROM words WHERE len(w) > 0),
    sizes AS (SELECT doc_id, count(*) AS n FROM grams GROUP BY doc_id),
    shared AS (SELECT a.doc_id AS a, b.doc_id AS b, count(*) AS k FROM grams a JOIN grams b ON a.g = b.g AND a.doc_id <> b.doc_id GROUP BY ALL),
    near AS (SELECT a, b FROM shared JOIN sizes x ON x.doc_id = a JOIN sizes y ON y.doc_id = b WHERE k / (x.n + y.n - k) >= {jaccard.THRESHOLD}),
    reach AS (SELECT a, b FROM near UNION SELECT r.a, n.b FROM reach r JOIN near n ON n.a = r.b),
    lowest AS (SELECT a, min(b) AS b FROM reach GROUP BY 1),
    many AS (SELECT a, count(*) AS links FROM near GROUP BY 1)
    SELECT doc_id, coalesce(least(doc_id, b), doc_id) AS class_id, coalesce(links, 0) AS links
    FROM (SELECT DISTINCT doc_id FROM documents WHERE doc_id IS NOT NULL) d LEFT JOIN lowest ON lowest.a = doc_id LEFT JOIN many ON many.a = doc_id"""


def _trigrams(source: str, keys: str) -> str:
    return f"SELECT {keys}, i - 1 AS pos, w[i] || ' ' || w[i + 1] || ' ' || w[i + 2] AS g FROM (SELECT *, unnest(range(1, len(w) - 1)) AS i FROM {source})"


#: The best of all windows of an item's words by exact similarity, of pairs that share enough shingles anywhere for some window to reach the threshold. Neither fingerprints nor the radius come in.
DECONTAM = f"""
    WITH its AS (SELECT row_number() OVER () AS k, item_id, w, len(w) AS size, CASE WHEN len(w) < {decontam.WHOLE_BELOW} THEN 1.0 ELSE {decontam.THRESHOLD} END::DOUBLE AS least
        FROM (SELECT item_id, {words("text")} AS w FROM (SELECT DISTINCT item_id, text FROM benchmark WHERE item_id IS NOT NULL AND text IS NOT NULL)) WHERE len(w) > 0),
    ig AS ({_trigrams("its", "k, size")}),
    own AS (SELECT DISTINCT k, g FROM ig UNION SELECT k, array_to_string(w, ' ') FROM its WHERE size < 3),
    base AS (SELECT ln(1 + count(*)::DOUBLE) AS v FROM its),
    wt AS (SELECT g, ln(1 + (SELECT count(*)::DOUBLE FROM its) / count(*)) AS v FROM own GROUP BY g),
    iw AS (SELECT k, sum(v) AS weight FROM own JOIN wt USING (g) GROUP BY k),
    d AS (SELECT row_number() OVER () AS r, doc_id, len(w) AS n, w FROM (SELECT doc_id, {words("text")} AS w FROM documents WHERE doc_id IS NOT NULL AND text IS NOT NULL)),
    dg AS ({_trigrams("d", "r, doc_id, n")}),
    shared AS (SELECT DISTINCT r, doc_id, n, k, g FROM dg JOIN own USING (g)),
    possible AS (SELECT r, doc_id, n, k, size, weight, least, unnest(range(0, greatest(n - size, 0) + 1)) AS s FROM
        (SELECT r, doc_id, n, k, size, weight, least FROM shared JOIN wt USING (g) JOIN iw USING (k) JOIN its USING (k) WHERE size >= 3 GROUP BY ALL HAVING sum(v) >= least * weight - 1e-9)),
    win AS (SELECT DISTINCT p.*, g FROM possible p JOIN dg ON dg.r = p.r AND pos BETWEEN s AND s + size - 3),
    summed AS (SELECT win.r, doc_id, n, win.k, size, weight, least, s, sum(coalesce(v, (SELECT v FROM base))) AS total, coalesce(sum(v) FILTER (own.g IS NOT NULL), 0) AS both_
        FROM win LEFT JOIN wt ON wt.g = win.g LEFT JOIN own ON own.k = win.k AND own.g = win.g GROUP BY ALL),
    brief AS (SELECT doc_id, item_id, s, size FROM (SELECT *, unnest(range(0, n - size + 1)) AS s FROM d JOIN (SELECT k, item_id, size, w AS iw FROM its WHERE size < 3) i ON n >= size) WHERE w[s + 1 : s + size] = iw),
    scored AS (SELECT doc_id, item_id, s::INT AS start_word, least(summed.size, n)::INT AS n_words, round(both_ / (total + weight - both_), 6) AS similarity, summed.least FROM summed JOIN its ON its.k = summed.k
        UNION ALL SELECT doc_id, item_id, s::INT, size::INT, 1.0, 1.0 FROM brief)
    SELECT * EXCLUDE (least) FROM scored WHERE similarity >= least QUALIFY row_number() OVER (PARTITION BY doc_id, item_id ORDER BY similarity DESC, start_word, n_words) = 1"""


def _license() -> str:
    """Pieces of lines, cut at line ends and end signs; known sentences over one or several of them, joined by their words; then the rules one after the other."""
    gap = license.GAP
    cut = lambda t: f"string_split(regexp_replace(regexp_replace(regexp_replace({t}, '\\r\\n', chr(10), 'g'), '([.!?;:])([\\t\\x0b\\x0c ])', '\\1' || chr(1) || '\\2', 'g'), '[\\r\\n]', chr(1) || chr(2), 'g'), chr(1))"
    values = [f"({n}, {quoted(name)}, {quoted(rule)}, {k}, {quoted(line)})" for n, (name, rule, lines) in enumerate(license.RULES) for k, line in enumerate(lines)]
    key = f"array_to_string({words('s')}, ' ')"
    ctes = f"""
    WITH lines AS (SELECT * FROM (VALUES {", ".join(values)}) t(n, license, rule, k, line)),
    parts AS MATERIALIZED (SELECT n, license, rule, row_number() OVER (PARTITION BY n ORDER BY k, j) AS j, key FROM (
        SELECT n, license, rule, k, j, {key} AS key FROM (SELECT n, license, rule, k, unnest({cut("line")}) AS s, generate_subscripts({cut("line")}, 1) AS j FROM lines)) WHERE key <> ''),
    known AS (SELECT DISTINCT key FROM parts),
    raw_ AS (SELECT r, doc_id, j, s, {key} AS key, starts_with(s, chr(2))::INT AS broke FROM (SELECT r, doc_id, unnest({cut("text")}) AS s, generate_subscripts({cut("text")}, 1) AS j FROM (SELECT row_number() OVER () AS r, doc_id, text FROM documents WHERE text IS NOT NULL))),
    numbered AS (SELECT *, count(*) FILTER (key <> '') OVER (PARTITION BY r ORDER BY j) AS c, sum(broke) OVER (PARTITION BY r ORDER BY j) AS breaks FROM raw_),
    signs AS (SELECT r, c, bool_or(breaks = own AND regexp_matches(s, '[.!?;:][\\t-\\r ]*$')) AS ended FROM (SELECT *, min(breaks) OVER (PARTITION BY r, c) AS own FROM numbered) GROUP BY ALL),
    piece AS MATERIALIZED (SELECT n.r, doc_id, n.c - 1 AS p, key, n.c > 1 AND breaks - lag(breaks) OVER (PARTITION BY n.r ORDER BY n.c) = 1 AND NOT s.ended AS soft FROM (SELECT * FROM numbered WHERE key <> '') n LEFT JOIN signs s ON s.r = n.r AND s.c = n.c - 1),
    hard AS (SELECT *, sum((NOT coalesce(soft, false))::INT) OVER (PARTITION BY r ORDER BY p) AS h FROM piece),
    begun AS (SELECT r, p, k.key AS whole FROM piece JOIN known k ON k.key <> piece.key AND starts_with(k.key || ' ', piece.key || ' ')),
    grown AS (SELECT b.r, b.p, whole, s.p AS q, string_agg(s.key, ' ') OVER w AS said, bool_and(s.p = b.p OR s.soft) OVER w AS soft FROM begun b JOIN piece s ON s.r = b.r AND s.p BETWEEN b.p AND b.p + 200 WINDOW w AS (PARTITION BY b.r, b.p, whole ORDER BY s.p)),
    joined AS (SELECT r, p AS a, q AS z, whole AS key FROM grown WHERE said = whole AND soft QUALIFY row_number() OVER (PARTITION BY r, p ORDER BY length(whole) DESC) = 1),
    hits AS (SELECT r, a, z, key FROM joined UNION ALL SELECT r, p, p, key FROM piece WHERE key IN (SELECT key FROM known) AND NOT EXISTS (SELECT 1 FROM joined x WHERE x.r = piece.r AND piece.p BETWEEN x.a AND x.z)),
    u0 AS MATERIALIZED (SELECT hits.r, b.doc_id, a, z, hits.key, coalesce(b.h - (NOT coalesce(b.soft, false))::INT, 0) AS before, coalesce(n.h, e.h) AS after FROM hits JOIN hard b ON b.r = hits.r AND b.p = hits.a JOIN hard e ON e.r = hits.r AND e.p = hits.z LEFT JOIN hard n ON n.r = hits.r AND n.p = hits.z + 1)"""
    out, level, at = [], 0, 0
    sizes = [sum(len(license.sentences(*kernels.buffers(pa.array([line]))).hash) for line in lines) for _, _, lines in license.RULES]
    while at < len(sizes):
        n, size = at, sizes[at]
        end = at + 1
        if size == 1:  # a run of single-sentence rules is one step
            while end < len(sizes) and sizes[end] == 1:
                end += 1
            ctes += f""",
    m{level} AS MATERIALIZED (SELECT r, doc_id, license, rule, a AS first, z AS last, 1 AS c FROM (SELECT u.*, license, rule, row_number() OVER (PARTITION BY r, a ORDER BY n) AS o FROM u{level} u JOIN parts ON parts.key = u.key AND n BETWEEN {n} AND {end - 1}) WHERE o = 1),
    u{level + 1} AS MATERIALIZED (SELECT u.* FROM u{level} u ANTI JOIN m{level} m ON m.r = u.r AND m.first = u.a)"""
            out.append(f"SELECT doc_id, license, rule, first::INT AS first_sentence, last::INT AS last_sentence, c::INT AS sentences FROM m{level}")
        else:
            step = f"SELECT r, doc_id, a AS a1, z AS z1, after AS f1 FROM u{level} JOIN parts ON parts.key = u{level}.key AND n = {n} AND j = 1"
            for j in range(2, size + 1):
                o = j - 1
                step = f"SELECT s.*, min(u.a) AS a{j}, arg_min(u.z, u.a) AS z{j}, arg_min(u.after, u.a) AS f{j} FROM ({step}) s JOIN u{level} u ON u.r = s.r AND u.a > s.z{o} JOIN parts ON parts.key = u.key AND n = {n} AND j = {j} GROUP BY ALL HAVING min(u.a) - s.z{o} <= {gap + 1} OR 1 + arg_min(u.before, u.a) - s.f{o} <= {gap}"
            places = ", ".join(f"a{j}" for j in range(1, size + 1))
            ctes += f""",
    m{level} AS MATERIALIZED (SELECT * FROM ({step}) QUALIFY row_number() OVER (PARTITION BY r, a{size} ORDER BY a1) = 1),
    x{level} AS (SELECT r, unnest([{places}]) AS a FROM m{level}),
    u{level + 1} AS MATERIALIZED (SELECT u.* FROM u{level} u ANTI JOIN x{level} x ON x.r = u.r AND x.a = u.a)"""
            name, rule, _ = license.RULES[n]
            out.append(f"SELECT doc_id, {quoted(name)}, {quoted(rule)}, a1::INT, z{size}::INT, {size}::INT FROM m{level}")
        level += 1
        at = end
    first = next(k for k, s in enumerate(out) if "AS first_sentence" in s)
    out.insert(0, out.pop(first))
    return ctes + "\n    " + " UNION ALL ".join(out)


LICENSE = _license()
