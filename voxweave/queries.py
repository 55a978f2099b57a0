"""One query for each operator over the driver's tables, and the DuckDB SQL that gives the same rows.

conversations play recordings (conv_id) of speaker turns (role) in milliseconds; events play samples of sound; documents are
transcripts; pages are web pages and URLs; orders, customer and part make candidates, registries and labels.
"""

from __future__ import annotations

import uuid
from collections.abc import Callable

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from .functions import text as T
from .functions import vectors as V
from .operators import cache as C
from .operators import catalog as L
from .operators import correction as K
from .operators import curated as U
from .operators import glossary as G
from .operators import intervals as I
from .operators import metadata as M
from .operators import signal as S
from .operators import speakers as P
from .operators.spread import spread
from .plans import speech
from .sources import tables as R
from .streaming import incremental as N

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}
SQL: dict[str, str] = {}


def query(sql: str | None = None) -> Callable[[Query], Query]:
    def add(f: Query) -> Query:
        QUERIES[f.__name__] = f
        if sql:
            SQL[f.__name__] = sql
        return f

    return add


def read(spark: SparkSession, sf: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf}/{name}.parquet")


col, lit = F.col, F.lit
SECOND = 1000

# inputs


def turns(spark: SparkSession, sf: str) -> DataFrame:
    """Turns of 60 ms a character, one after the other, each running 2 s into the next."""
    t = read(spark, sf, "conversations").select(col("conv_id").alias("podcast_id"), col("turn").alias("seg_idx"), col("role").alias("speaker"), (F.length("text") * 60).cast("long").alias("duration"))
    out = I.rebased(t)
    return out.select("podcast_id", col("seg_idx").alias("turn_idx"), "speaker", "start", (col("end") + 2000).alias("end"), "duration")


def lengths(t: DataFrame) -> DataFrame:
    return t.groupBy("podcast_id").agg(F.max("end").alias("duration"))


def windows(t: DataFrame) -> DataFrame:
    return I.fixed(lengths(t), 15 * SECOND, 10 * SECOND).withColumn("speaker", lit("SPEAKER_00"))


TURNS = """
    t0 AS (SELECT conv_id AS podcast_id, turn AS turn_idx, role AS speaker, 60 * length(text) AS duration,
        coalesce(sum(60 * length(text)) OVER (PARTITION BY conv_id ORDER BY turn ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0)::BIGINT AS a FROM conversations),
    turns AS (SELECT *, a + duration + 2000 AS z FROM t0),
    lengths AS (SELECT podcast_id, max(z) AS total FROM turns GROUP BY 1),
    windows AS (SELECT podcast_id, k AS seg_idx, k * 15000 AS s, least((k + 1) * 15000, total) AS e
        FROM (SELECT podcast_id, total, unnest(range(0, greatest(ceil(total / 15000)::BIGINT, 1))) AS k FROM lengths) WHERE least((k + 1) * 15000, total) - k * 15000 >= 10000),
    overlap AS (SELECT w.podcast_id, seg_idx, turn_idx, speaker, greatest(s, a) - s AS o_start, least(e, z) - s AS o_end, least(e, z) - greatest(s, a) AS o
        FROM windows w JOIN turns t ON w.podcast_id = t.podcast_id AND greatest(s, a) < least(e, z)),
    spoken AS (SELECT podcast_id, seg_idx, speaker, sum(o)::BIGINT AS total, min(turn_idx) AS first FROM overlap GROUP BY ALL),
    purity AS (SELECT podcast_id, seg_idx, arg_max(speaker, total * 1000000 - first) AS dominant, max(total) / sum(total) AS purity, count(*) AS speakers, sum(total)::BIGINT AS seconds FROM spoken GROUP BY ALL)
"""


def samples(spark: SparkSession, sf: str) -> DataFrame:
    from pyspark.sql import Window

    e = read(spark, sf, "events")
    return e.select(col("user_id").alias("podcast_id"), (F.row_number().over(Window.partitionBy("user_id").orderBy("ts", "event_id")) - 1).alias("idx"), F.unix_micros(col("ts").cast("timestamp")).alias("t"), (col("value") / 100).alias("x"))


SAMPLES = """samples AS (SELECT user_id AS podcast_id, row_number() OVER (PARTITION BY user_id ORDER BY ts, event_id) - 1 AS idx, epoch_us(ts) AS t, value / 100 AS x FROM events)"""
ENERGY = f"""{SAMPLES}, energy AS (SELECT podcast_id, idx // 4 AS win, avg(x * x) AS energy, min(t) AS a, max(t) AS z FROM samples GROUP BY ALL)"""


def labels(spark: SparkSession, sf: str) -> DataFrame:
    o = read(spark, sf, "orders")
    k = col("o_orderkey") % 7
    n = col("o_custkey").cast("string")
    return o.select("o_orderkey", F.when(k == 0, F.concat(lit("SPEAKER_"), n)).when(k == 1, F.concat(lit("SPEAKER_GLOBAL_"), n)).when(k == 2, F.format_string("SPK_%02d", F.pmod("o_custkey", lit(100)))).when(k == 3, F.concat(lit("voz"), n)).when(k == 4, lit("SPEAKER_x")).when(k == 5, lit("ana")).otherwise(F.concat(lit("SPK_"), n)).alias("label"))


LABELS = """labels_ AS (SELECT o_orderkey, CASE o_orderkey % 7 WHEN 0 THEN 'SPEAKER_' || o_custkey WHEN 1 THEN 'SPEAKER_GLOBAL_' || o_custkey WHEN 2 THEN format('SPK_{:02d}', o_custkey % 100)
    WHEN 3 THEN 'voz' || o_custkey WHEN 4 THEN 'SPEAKER_x' WHEN 5 THEN 'ana' ELSE 'SPK_' || o_custkey END AS label FROM orders)"""


def numbers_text(spark: SparkSession, sf: str) -> DataFrame:
    o = read(spark, sf, "orders")
    s = lambda c: c.cast("string")
    return o.select("o_orderkey", F.concat(lit("hay "), s(col("o_orderkey") * 7), lit(" casos, o "), s(col("o_custkey")), lit("% de x"), s(col("o_custkey")), lit("; 3."), s(col("o_orderkey") % 10), lit(" y 0012")).alias("text"))


def spoken_text(spark: SparkSession, sf: str) -> DataFrame:
    """Short Spanish sentences, some asked, some shouted, badly spaced."""
    o = read(spark, sf, "orders")
    k, m = col("o_orderkey") % 6, col("o_orderkey") % 5
    first = F.when(k == 0, "que es el marketing ?").when(k == 1, "tienes  5 minutos ,amigo?").when(k == 2, "no manches guey , que chido !").when(k == 3, "claro.si !").when(k == 4, "( gemina y google ) son ia .").otherwise("¿ ya sabes ?")
    second = F.when(m == 0, " el 50% usan seo.").when(m == 1, " órale, vamos!").when(m == 2, " te gusta esto?").when(m == 3, " cuánto bueno!").otherwise("")
    return o.select("o_orderkey", F.concat(first, second, lit(" fin.")).alias("text"))


SPOKEN = """spoken_text AS (SELECT o_orderkey, CASE o_orderkey % 6 WHEN 0 THEN 'que es el marketing ?' WHEN 1 THEN 'tienes  5 minutos ,amigo?' WHEN 2 THEN 'no manches guey , que chido !' WHEN 3 THEN 'claro.si !' WHEN 4 THEN '( gemina y google ) son ia .' ELSE '¿ ya sabes ?' END
    || CASE o_orderkey % 5 WHEN 0 THEN ' el 50% usan seo.' WHEN 1 THEN ' órale, vamos!' WHEN 2 THEN ' te gusta esto?' WHEN 3 THEN ' cuánto bueno!' ELSE '' END || ' fin.' AS text FROM orders)"""


#: Whole documents beside the made sentences, by id; made ones have what documents seldom do: numbers, questions, calls.
def real_and(made: DataFrame, spark: SparkSession, sf: str) -> DataFrame:
    d = read(spark, sf, "documents").select(F.concat(lit("d"), "doc_id").alias("id"), "text")
    return made.select(F.concat(lit("o"), "o_orderkey").alias("id"), "text").unionByName(d)


def real_and_sql(made: str) -> str:
    return f"every AS (SELECT 'o' || o_orderkey AS id, text FROM {made} UNION ALL SELECT 'd' || doc_id, text FROM documents)"


def quoted(s: str) -> str:
    return "'" + s.replace("'", "''") + "'"


def strip_sql(e: str) -> str:
    return f"regexp_replace({e}, '^\\s+|\\s+$', '', 'g')"


def spaced_sql(e: str) -> str:
    e = f"regexp_replace({e}, ' +', ' ', 'g')"
    e = f"regexp_replace({e}, ' +([)?!:;,.])', '\\1', 'g')"
    e = f"regexp_replace({e}, '([?!:;,.])([ÁÉÍÓÚÑáéíóúña-zA-Z])', '\\1 \\2', 'g')"
    return strip_sql(f"regexp_replace({e}, '([¿¡(]) +', '\\1', 'g')")


def glossary_sql(e: str, rules: list[tuple[str, str]]) -> str:
    import re

    for error, correction in rules:
        if T.ignores_case(error, correction):
            e = f"regexp_replace({e}, {quoted('(?i)' + re.escape(error).replace(chr(92) + ' ', ' '))}, {quoted(correction)}, 'g')"
        else:
            e = f"replace({e}, {quoted(error)}, {quoted(correction)})"
    return e


WORDS = "[" + ",".join(quoted(w) for w in T.number_words()) + "]"


def spoken_sql(n: str) -> str:
    head = f"CASE WHEN {n} // 1000 = 1 THEN 'mil' ELSE words[{n} // 1000 + 1] || ' mil' END"
    return f"CASE WHEN {n} < 1000 THEN words[{n} + 1] WHEN {n} < 1000000 THEN {head} || CASE WHEN {n} % 1000 = 0 THEN '' ELSE ' ' || words[{n} % 1000 + 1] END WHEN {n} = 1000000 THEN 'un millón' ELSE {n}::VARCHAR END"


def numbers_sql(source: str) -> str:
    """A CTE body (id, text) from a relation of the same columns."""
    return f"""SELECT id, array_to_string([CASE
            WHEN NOT regexp_matches(toks[i], '^[0-9]') THEN CASE WHEN i > 1 AND starts_with(toks[i], '%') THEN ' por ciento' || substr(toks[i], 2) ELSE toks[i] END
            WHEN starts_with(coalesce(toks[i + 1], ''), '%') THEN {spoken_sql("toks[i]::BIGINT")}
            WHEN length(toks[i]) <= 4 AND (i = 1 OR NOT regexp_matches(toks[i - 1], '[\\pL\\pN_]$')) AND (i = len(toks) OR regexp_matches(toks[i + 1], '^[?!:;,.\\s]')) THEN {spoken_sql("toks[i]::BIGINT")}
            ELSE toks[i] END FOR i IN range(1, len(toks) + 1)], '') AS text
        FROM (SELECT id, regexp_extract_all(text, '([0-9]+|[^0-9]+)') AS toks, {WORDS} AS words FROM {source})"""


def opened_sql(e: str) -> str:
    cues = "|".join(T.QUESTION_STARTS)
    question = f"(regexp_matches(lower(s), '^(?:{cues})') OR regexp_matches(substr(lower(s), 1, 30), ' (?:{cues})') OR regexp_matches(lower(s), '{T.QUESTION}'))"
    shout = f"(regexp_matches(lower(s), '^(?:{'|'.join(T.EXCLAMATION_STARTS)})') OR regexp_matches(lower(s), '{T.EXCLAMATION}'))"
    pieces = f"string_split(regexp_replace({e}, '([.!?])\\s+', '\\1' || chr(1), 'g'), chr(1))"
    one = f"CASE WHEN s LIKE '%?' AND s NOT LIKE '¿%' AND {question} THEN '¿' || s WHEN s LIKE '%!' AND s NOT LIKE '¡%' AND {shout} THEN '¡' || s ELSE s END"
    return f"array_to_string([{one} FOR s IN {pieces} IF s <> ''], ' ')"


def capitals_sql(e: str) -> str:
    pieces = f"string_split(regexp_replace({e}, '([.!?¿¡]\\s+)([a-záéíóúñ])', '\\1' || chr(1) || '\\2', 'g'), chr(1))"
    return f"array_to_string([upper(substr(p, 1, 1)) || substr(p, 2) FOR p IN {pieces}], '')"


RULES = G.default_rules()

# intervals


@query(f"WITH {TURNS} SELECT podcast_id, seg_idx, turn_idx, speaker, o_start::BIGINT AS \"start\", o_end::BIGINT AS \"end\", o::BIGINT AS overlap FROM overlap")
def interval_overlap_join(spark, sf):
    t = turns(spark, sf)
    return I.overlaps(windows(t), t, bucket=60 * SECOND)


@query(f"WITH {TURNS} SELECT podcast_id, seg_idx, dominant, round(purity, 9) AS purity, speakers, seconds FROM purity")
def speaker_purity(spark, sf):
    t = turns(spark, sf)
    return I.purity(I.overlaps(windows(t), t, 60 * SECOND)).withColumn("purity", F.round("purity", 9))


@query(f"WITH {TURNS} SELECT w.podcast_id, w.seg_idx, s::BIGINT AS \"start\", e::BIGINT AS \"end\", coalesce(dominant, 'SPEAKER_00') AS speaker FROM windows w LEFT JOIN purity p ON p.podcast_id = w.podcast_id AND p.seg_idx = w.seg_idx")
def overlap_assignment(spark, sf):
    t = turns(spark, sf)
    return I.assigned(windows(t).drop("speaker"), t, 15 * SECOND, 60 * SECOND)


DECIDED = """, seen AS (SELECT w.podcast_id, w.seg_idx, s, e, dominant, purity, CASE WHEN speakers IS NULL THEN 'keep' WHEN speakers > 2 THEN 'split' WHEN purity < 0.8 THEN 'drop' ELSE 'keep' END AS decision
    FROM windows w LEFT JOIN purity p ON p.podcast_id = w.podcast_id AND p.seg_idx = w.seg_idx)"""


@query(f"WITH {TURNS}{DECIDED} SELECT podcast_id, count(*) AS total, count(*) FILTER (decision = 'keep') AS kept, count(*) FILTER (decision = 'split') AS split, count(*) FILTER (decision = 'drop') AS dropped FROM seen GROUP BY 1")
def speaker_purity_review(spark, sf):
    """Segments kept, split and dropped in each recording: turns, fixed segments, overlap join, purity, decision."""
    t = turns(spark, sf)
    return I.review_counts(I.reviewed(windows(t), t, max_speakers=2, bucket=60 * SECOND))


@query(f"""WITH {TURNS}, seen AS (SELECT w.podcast_id, w.seg_idx, s, e, dominant, purity, coalesce(speakers, 0) AS n FROM windows w LEFT JOIN purity p ON p.podcast_id = w.podcast_id AND p.seg_idx = w.seg_idx),
    long AS (SELECT o.podcast_id, o.seg_idx, turn_idx, speaker, s + o_start AS a, s + o_end AS z FROM overlap o JOIN seen x ON x.podcast_id = o.podcast_id AND x.seg_idx = o.seg_idx WHERE n > 1 AND o >= 5000),
    pieces AS (SELECT podcast_id, seg_idx, a, turn_idx, a AS "start", z AS "end", speaker, NULL::DOUBLE AS speaker_purity, seg_idx AS split_from FROM long
        UNION ALL SELECT podcast_id, seg_idx, s, 0, s, e, 'SPEAKER_00', NULL, seg_idx FROM seen x WHERE n > 1 AND NOT EXISTS (SELECT 1 FROM long l WHERE l.podcast_id = x.podcast_id AND l.seg_idx = x.seg_idx)
        UNION ALL SELECT podcast_id, seg_idx, s, 0, s, e, coalesce(dominant, 'SPEAKER_00'), coalesce(purity, 1.0), NULL FROM seen WHERE n <= 1 AND coalesce(purity, 1) >= 0.8)
    SELECT podcast_id, row_number() OVER (PARTITION BY podcast_id ORDER BY seg_idx, a, turn_idx) - 1 AS segment, "start"::BIGINT AS "start", "end"::BIGINT AS "end", speaker, speaker_purity, split_from FROM pieces""")
def segment_review(spark, sf):
    t = turns(spark, sf)
    return I.review(windows(t), t, 1, 0.8, 5 * SECOND, 60 * SECOND)


@query(f"WITH {TURNS} SELECT podcast_id, seg_idx, s::BIGINT AS \"start\", e::BIGINT AS \"end\" FROM windows")
def fixed_segments(spark, sf):
    return windows(turns(spark, sf)).drop("speaker")


@query(f"""WITH {TURNS}, clamped AS (SELECT t.podcast_id, turn_idx, speaker, greatest(a, 0) AS a, least(z, total - 1000) AS z FROM turns t JOIN lengths l ON l.podcast_id = t.podcast_id),
    cut AS (SELECT podcast_id, turn_idx, speaker, k, a + k * 15000 AS a, least(a + (k + 1) * 15000, z) AS z FROM (SELECT *, unnest(range(0, ceil((z - a) / 15000)::BIGINT)) AS k FROM clamped WHERE z - a >= 10000 AND z > a))
    SELECT podcast_id, row_number() OVER (PARTITION BY podcast_id ORDER BY a, turn_idx, k) - 1 AS seg_idx, a AS "start", z AS "end", speaker FROM cut WHERE z - a >= 10000""")
def turn_segments(spark, sf):
    t = turns(spark, sf)
    total = lengths(t).withColumnRenamed("duration", "total")
    return I.by_turn(t.join(total, "podcast_id"), col("total") - 1000, 15 * SECOND, 10 * SECOND)


@query()
def silence_fill(spark, sf):
    """A fold in order, tested against plain Python."""
    t = turns(spark, sf)
    return I.filled(t.select("podcast_id", col("turn_idx").alias("chunk_idx"), (col("duration") / 4).alias("duration")), 15 * SECOND, 10 * SECOND)


@query("SELECT conv_id AS podcast_id, turn AS seg_idx, 60 * length(text) AS duration, coalesce(sum(60 * length(text)) OVER w, 0)::BIGINT AS \"start\", (coalesce(sum(60 * length(text)) OVER w, 0) + 60 * length(text))::BIGINT AS \"end\" FROM conversations WINDOW w AS (PARTITION BY conv_id ORDER BY turn ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING)")
def rebased_time(spark, sf):
    return I.rebased(read(spark, sf, "conversations").select(col("conv_id").alias("podcast_id"), col("turn").alias("seg_idx"), (F.length("text") * 60).cast("long").alias("duration")))


# sound


@query(f"WITH {ENERGY} SELECT podcast_id, win AS \"window\", round(energy, 10) AS energy, a AS \"start\", z AS \"end\" FROM energy")
def window_energy(spark, sf):
    return S.window_energy(samples(spark, sf), 4).withColumn("energy", F.round("energy", 10))


@query(f"""WITH {ENERGY}, m AS (SELECT podcast_id, median(energy) AS m FROM energy GROUP BY 1), total AS (SELECT podcast_id, max(t) + 1000000 AS d FROM samples GROUP BY 1),
    flags AS (SELECT e.podcast_id, win, a, coalesce(abs(energy - lag(energy) OVER (PARTITION BY e.podcast_id ORDER BY win)) > 0.5 * m, false)::INT AS c FROM energy e JOIN m ON m.podcast_id = e.podcast_id),
    runs AS (SELECT podcast_id, turn_idx, min(a) AS a FROM (SELECT *, sum(c) OVER (PARTITION BY podcast_id ORDER BY win) AS turn_idx FROM flags) GROUP BY ALL)
    SELECT r.podcast_id, turn_idx::BIGINT AS turn_idx, a AS "start", coalesce(lead(a) OVER (PARTITION BY r.podcast_id ORDER BY turn_idx), d) AS "end", format('SPEAKER_{{:02d}}', (turn_idx % 3)::INT) AS speaker FROM runs r JOIN total t ON t.podcast_id = r.podcast_id""")
def energy_diarization(spark, sf):
    s = samples(spark, sf)
    return S.energy_turns(S.window_energy(s, 4), s.groupBy("podcast_id").agg((F.max("t") + 1_000_000).alias("duration")))


@query(f"WITH {SAMPLES} SELECT podcast_id, f AS frame, round(sqrt(avg(x * x)), 9) AS rms FROM (SELECT *, unnest(range(greatest(ceil((idx - 7) / 4)::BIGINT, 0), idx // 4 + 1)) AS f, max(idx) OVER (PARTITION BY podcast_id) AS last FROM samples) WHERE f * 4 + 7 <= last GROUP BY ALL")
def sliding_rms(spark, sf):
    return S.sliding_rms(samples(spark, sf), 8, 4).withColumn("rms", F.round("rms", 9))


@query(f"""WITH {SAMPLES}, s AS (SELECT podcast_id, max(abs(x)) AS p, sqrt(avg(x * x)) AS r FROM samples GROUP BY 1), g AS (SELECT *, pow(10::DOUBLE, (-23 + 0.691::DOUBLE) / 20) / r AS gain FROM s)
    SELECT podcast_id, round(p, 6) AS peak, round(r, 6) AS rms, round(20 * log10(r) - 0.691::DOUBLE, 6) AS lufs, round(gain, 6) AS gain, round(least(p * 2, CASE WHEN p * 2 > pow(10::DOUBLE, -0.05::DOUBLE) THEN pow(10::DOUBLE, -0.05::DOUBLE) ELSE p * 2 END), 6) AS limited_peak FROM g""")
def signal_figures(spark, sf):
    r, twice = col("rms"), F.array(col("peak") * 2)
    return S.signal_stats(samples(spark, sf)).select("podcast_id", F.round("peak", 6).alias("peak"), F.round(r, 6).alias("rms"), F.round(V.loudness(r), 6).alias("lufs"), F.round(V.gain(r), 6).alias("gain"), F.round(V.peak(V.limited(twice)), 6).alias("limited_peak"))


# labels, ids, urls


@query(f"""WITH {LABELS}, n AS (SELECT *, nullif(regexp_extract(label, 'SPEAKER_(?:GLOBAL_)?([0-9]+)', 1), '')::BIGINT AS own, nullif(regexp_extract(label, '([0-9]+)', 1), '')::BIGINT AS any_ FROM labels_)
    SELECT o_orderkey, label, CASE WHEN regexp_matches(label, '^SPK_[0-9]{{2}}$') THEN label ELSE format('SPK_{{:02d}}', coalesce(own, any_, 0)) END AS code, CASE WHEN any_ IS NOT NULL THEN format('SPK_{{:02d}}', any_) ELSE label END AS fallback,
    CASE WHEN contains(label, 'SPEAKER_') THEN coalesce(try_cast(string_split(label, '_')[2] AS INT), 0) ELSE (('0x' || substr(md5(label), 1, 8))::BIGINT % 1000)::INT END AS number FROM n""")
def speaker_codes(spark, sf):
    x = labels(spark, sf)
    return x.select("o_orderkey", "label", T.speaker_code(col("label")).alias("code"), T.fallback_speaker(col("label")).alias("fallback"), T.speaker_number(col("label")).alias("number"))


@query("SELECT page_id, substr(regexp_replace(url, '[^0-9A-Za-z_-]', '_', 'g'), 1, 50) AS podcast_id FROM pages")
def clean_ids(spark, sf):
    return read(spark, sf, "pages").select("page_id", T.clean_id(col("url")).alias("podcast_id"))


VIDEOS = """v AS (SELECT page_id, CASE page_id % 4 WHEN 0 THEN 'https://youtu.be/' WHEN 1 THEN 'https://x.example/watch?v=' WHEN 2 THEN 'https://x.example/embed/' ELSE '' END || substr(md5(url), 1, 11) || CASE page_id % 3 WHEN 0 THEN '&list=PL1' WHEN 1 THEN '?list=a' ELSE '' END AS u FROM pages)"""


@query(f"WITH {VIDEOS} SELECT page_id, coalesce(nullif(regexp_extract(u, '(?:youtu\\.be/|/v/|v=)([0-9A-Za-z_-]{{11}})', 1), ''), nullif(regexp_extract(u, 'embed/([0-9A-Za-z_-]{{11}})', 1), ''), nullif(regexp_extract(u, '^([0-9A-Za-z_-]{{11}})$', 1), '')) AS video_id, CASE WHEN contains(u, '&list=') THEN string_split(u, '&list=')[1] ELSE string_split(u, '?list=')[1] END AS url FROM v")
def video_ids(spark, sf):
    k, m = col("page_id") % 4, col("page_id") % 3
    u = F.concat(F.when(k == 0, "https://youtu.be/").when(k == 1, "https://x.example/watch?v=").when(k == 2, "https://x.example/embed/").otherwise(""), F.substring(F.md5("url"), 1, 11), F.when(m == 0, "&list=PL1").when(m == 1, "?list=a").otherwise(""))
    return read(spark, sf, "pages").select("page_id", T.video_id(u).alias("video_id"), T.without_playlist(u).alias("url"))


# text


@query(f"SELECT doc_id, {spaced_sql('text')} AS text FROM documents")
def text_spacing(spark, sf):
    return read(spark, sf, "documents").select("doc_id", T.spaced(col("text")).alias("text"))


@query(f"SELECT doc_id, {glossary_sql('text', RULES)} AS text FROM documents")
def text_glossary(spark, sf):
    return T.with_glossary(read(spark, sf, "documents").select("doc_id", "text"), "text", RULES)


@query("WITH n AS (SELECT o_orderkey, 'hay ' || o_orderkey * 7 || ' casos, o ' || o_custkey || '% de x' || o_custkey || '; 3.' || o_orderkey % 10 || ' y 0012' AS text FROM orders), " + real_and_sql("n") + " " + numbers_sql("every"))
def text_numbers(spark, sf):
    return T.with_numbers(real_and(numbers_text(spark, sf), spark, sf), "text")


@query(f"WITH {SPOKEN}, {real_and_sql('spoken_text')} SELECT id, {opened_sql(spaced_sql('text'))} AS text, len(string_split(regexp_replace(text, '([.!?])\\s+', '\\1' || chr(1), 'g'), chr(1))) AS sentences FROM every")
def text_opening_signs(spark, sf):
    x = real_and(spoken_text(spark, sf), spark, sf)
    return x.select("id", T.opened(T.spaced(col("text"))).alias("text"), F.size(T.sentences(col("text"))).cast("long").alias("sentences"))


@query(f"SELECT doc_id, {capitals_sql('text')} AS text FROM documents")
def text_capitals(spark, sf):
    return read(spark, sf, "documents").select("doc_id", T.capitalised(col("text")).alias("text"))


@query(f"""WITH {SPOKEN}, {real_and_sql('spoken_text')}, a AS (SELECT id, {spaced_sql('text')} AS text FROM every), b AS (SELECT id, {glossary_sql('text', RULES)} AS text FROM a), c AS ({numbers_sql('b')}), d AS (SELECT id, {opened_sql('text')} AS text FROM c),
    e AS (SELECT id, {strip_sql(capitals_sql('text'))} AS text FROM d) SELECT e.id, e.text, s.text AS text_original, e.text <> s.text AS text_changed FROM e JOIN every s ON s.id = e.id""")
def text_repair(spark, sf):
    return T.preprocessed(real_and(spoken_text(spark, sf), spark, sf), "text", RULES)


@query()
def text_change_log(spark, sf):
    """As text_repair, with what each stage did; tested against text_repair and by examples."""
    return T.with_changes(real_and(spoken_text(spark, sf), spark, sf), "text", RULES).select("id", "text", F.to_json("changes").alias("changes"))


@query()
def text_stage_counts(spark, sf):
    """How many texts each stage changed; tested against the change log."""
    return T.stage_counts(T.with_changes(real_and(spoken_text(spark, sf), spark, sf), "text", RULES))


@query(f"SELECT doc_id, md5(lower({strip_sql('text')})) AS text_hash FROM documents")
def text_hashes(spark, sf):
    return read(spark, sf, "documents").select("doc_id", T.text_hash(col("text")).alias("text_hash"))


@query("SELECT doc_id, translate(text, 'áéíóúäëïöüàèìòùñ', 'aeiouaeiouaeioun') AS text FROM documents")
def text_unaccented(spark, sf):
    return read(spark, sf, "documents").select("doc_id", T.unaccented(col("text")).alias("text"))


@query(f"SELECT page_id, substr({strip_sql(f"regexp_replace(translate(lower(url), {quoted(T.TITLE_SIGNS)}, {quoted(' ' * len(T.TITLE_SIGNS))}), '\\s+', ' ', 'g')")}, 1, 50) AS title FROM pages")
def search_titles(spark, sf):
    """URLs in full-width letters, whose plain forms are the URLs."""
    letters = "abcdefghijklmnopqrstuvwxyz0123456789"
    wide = F.translate(F.lower("url"), letters, "".join(chr(ord(c) + 0xFEE0) for c in letters))
    return read(spark, sf, "pages").select("page_id", T.search_title(wide).alias("title"))


@query("WITH s AS (SELECT c_custkey, floor(c_acctbal * 3)::BIGINT AS s, c_acctbal < 0 AS neg FROM customer) SELECT c_custkey, CASE WHEN neg THEN '0:00' WHEN s // 3600 > 0 THEN (s // 3600) || 'h ' || (s % 3600 // 60) || 'm ' || (s % 60) || 's' WHEN s // 60 > 0 THEN (s // 60) || 'm ' || (s % 60) || 's' ELSE s || 's' END AS label FROM s")
def duration_labels(spark, sf):
    return read(spark, sf, "customer").select("c_custkey", T.duration_label(col("c_acctbal") * 3).alias("label"))


# glossary

COMMON = ",".join(quoted(w) for w in G.COMMON)
TERMS = f"""terms AS (SELECT DISTINCT page_id, term FROM (SELECT page_id, {strip_sql("regexp_replace(regexp_replace(t, '<[^>]+>', '', 'g'), '\\s+', ' ', 'g')")} AS term FROM (SELECT page_id, unnest(list_concat({', '.join(f"regexp_extract_all({'regexp_replace(html, {0}, {1}, {2})'.format(quoted('[À-ÖØ-öø-ɏ]'), quoted('_'), quoted('g')) if k == 0 else 'html'}, {quoted(p)}, 1)" for k, p in enumerate(G.TERM_PATTERNS))})) AS t FROM pages))
    WHERE length(term) BETWEEN 3 AND 50 AND lower(term) NOT IN ({COMMON}) AND regexp_matches(term, '\\p{{Lu}}'))"""


@query(f"WITH {TERMS} SELECT page_id, term FROM terms")
def page_terms(spark, sf):
    return G.page_terms(read(spark, sf, "pages"))


@query(f"WITH w AS (SELECT DISTINCT unnest(regexp_extract_all(text, '[A-ZÁÉÍÓÚÑ][a-záéíóúñ]+')) AS term FROM documents) SELECT DISTINCT * FROM (SELECT lower(term) AS error, term AS correction FROM w UNION ALL SELECT translate(term, {quoted(T.ACCENTED)}, {quoted(T.PLAIN)}), term FROM w) WHERE error <> correction")
def term_variants(spark, sf):
    w = read(spark, sf, "documents").select(F.explode(F.regexp_extract_all("text", lit("[A-ZÁÉÍÓÚÑ][a-záéíóúñ]+"), lit(0))).alias("term")).distinct()
    return G.variants(w)


PARTS = """base AS (SELECT p_partkey AS pos, p_name AS error, p_brand AS correction FROM part WHERE p_partkey % 3 = 0), custom AS (SELECT p_partkey AS pos, p_name AS error, p_type AS correction FROM part WHERE p_partkey % 3 <> 0)"""


def _rules(spark, sf):
    p = read(spark, sf, "part")
    pick = lambda base, c: p.where((col("p_partkey") % 3 == 0) == lit(base)).select(col("p_partkey").alias("pos"), col("p_name").alias("error"), col(c).alias("correction"))
    return pick(True, "p_brand"), pick(False, "p_type")


@query(f"WITH {PARTS}, a AS (SELECT 0 AS part, * FROM base UNION ALL SELECT 1, * FROM custom) SELECT row_number() OVER (ORDER BY min(part * 1000000000 + pos)) - 1 AS pos, error, arg_max(correction, part * 1000000000 + pos) AS correction FROM a GROUP BY error")
def glossary_merge(spark, sf):
    return G.merged(*_rules(spark, sf))


@query(f"WITH {PARTS}, a AS (SELECT 0 AS part, pos, error AS term FROM base UNION ALL SELECT 1, pos, error FROM custom), d AS (SELECT term, min(part * 1000000000 + pos) AS k FROM a GROUP BY 1) SELECT 'saved' AS form, row_number() OVER (ORDER BY k) - 1 AS pos, term FROM d UNION ALL SELECT 'loaded', row_number() OVER (ORDER BY part, pos) - 1, term FROM a")
def glossary_keep_terms(spark, sf):
    a, b = (x.select("pos", col("error").alias("term")) for x in _rules(spark, sf))
    return G.kept_terms(a, b, True).select(lit("saved").alias("form"), "pos", "term").unionByName(G.kept_terms(a, b).select(lit("loaded").alias("form"), "pos", "term"))


@query(f"WITH {PARTS}, old AS (SELECT error, min(correction) AS correction, 'base' AS category FROM base GROUP BY 1), new AS (SELECT error, arg_min(correction, pos) AS correction, 'new' AS category FROM custom WHERE lower(error) <> lower(correction) AND error NOT IN (SELECT error FROM old) GROUP BY 1) SELECT category, count(*) AS rules FROM (FROM old UNION ALL FROM new) GROUP BY 1")
def glossary_growth(spark, sf):
    a, b = _rules(spark, sf)
    old = a.groupBy("error").agg(F.min("correction").alias("correction")).withColumn("category", lit("base"))
    return G.growth(G.added(old, b.withColumn("category", lit("new"))))


@query("SELECT 'Correcciones:\n' || (SELECT string_agg('- \"' || p_name || '\" → \"' || p_brand || '\"', '\n' ORDER BY p_partkey) FROM part WHERE p_partkey < 30) || '\nMantener: ' || (SELECT string_agg(p_type, ', ' ORDER BY p_partkey) FROM part WHERE p_partkey < 30) AS context")
def glossary_context(spark, sf):
    p = read(spark, sf, "part")
    return K.glossary_context(p.select(col("p_partkey").alias("pos"), col("p_name").alias("error"), col("p_brand").alias("correction")), p.select(col("p_partkey").alias("pos"), col("p_type").alias("term")))


# cache

NOW = "TIMESTAMP '2024-06-01 00:00:00'"


def _cache(spark, sf) -> DataFrame:
    """An entry for each text: of even documents under its hash, of others as it was before a change, so that it is in the cache and isn't hit; ages and hits from the id."""
    d = read(spark, sf, "documents").select(T.text_hash(F.when(col("doc_id") % 2 == 0, col("text")).otherwise(F.concat("text", lit(" antes")))).alias("text_hash"), "doc_id")
    one = d.groupBy("text_hash").agg(F.min("doc_id").alias("k"))
    return one.select("text_hash", F.concat(lit("c"), "k").alias("text"), F.array(lit("x")).alias("changes"), lit(0.9).alias("confidence"), lit("m").alias("model"), F.expr(f"{NOW} - make_interval(0, 0, 0, CAST(k % 60 AS INT))").alias("created_at"), (col("k") % 5).alias("hits"), lit(None).cast("timestamp").alias("last_accessed"))


CACHE = f"""cache AS (SELECT text_hash, 'c' || k AS text, {NOW} - to_days((k % 60)::INT) AS created_at, k % 5 AS hits FROM (SELECT md5(lower({strip_sql("(CASE WHEN doc_id % 2 = 0 THEN text ELSE text || ' antes' END)")})) AS text_hash, min(doc_id) AS k FROM documents GROUP BY 1)),
    looked AS (SELECT doc_id, d.text_hash, c.text_hash IS NOT NULL AS hit, c.text AS cached FROM (SELECT doc_id, md5(lower({strip_sql('text')})) AS text_hash FROM documents) d LEFT JOIN cache c ON c.text_hash = d.text_hash)"""


@query(f"WITH {CACHE} SELECT * FROM looked")
def cache_lookup(spark, sf):
    return C.looked_up(read(spark, sf, "documents").select("doc_id", "text"), _cache(spark, sf)).select("doc_id", "text_hash", "hit", col("cached.text").alias("cached"))


@query(f"WITH {CACHE} SELECT count(*) FILTER (hit) AS hits, count(*) FILTER (NOT hit) AS misses, round(count(*) FILTER (hit) * 100.0::DOUBLE / count(*), 2) AS hit_rate FROM looked")
def cache_figures(spark, sf):
    return C.figures(C.looked_up(read(spark, sf, "documents").select("doc_id", "text"), _cache(spark, sf)))


@query(f"WITH {CACHE} SELECT text_hash, text FROM cache WHERE created_at >= {NOW} - INTERVAL 30 DAYS")
def cache_expiry(spark, sf):
    return C.live(_cache(spark, sf), F.expr(NOW)).select("text_hash", "text")


@query(f"WITH {CACHE}, new AS (SELECT md5(lower({strip_sql('text')})) AS text_hash, 'n' || min(doc_id) AS text, {NOW} AS created_at, 0 AS hits FROM documents WHERE doc_id % 3 = 0 GROUP BY 1), every AS (SELECT * FROM new UNION ALL SELECT * FROM cache WHERE text_hash NOT IN (SELECT text_hash FROM new)) SELECT text_hash, text, hits FROM every ORDER BY hits DESC, created_at DESC, text_hash DESC LIMIT 100")
def cache_eviction(spark, sf):
    d = read(spark, sf, "documents").where("doc_id % 3 = 0").groupBy(T.text_hash(col("text")).alias("text_hash")).agg(F.concat(lit("n"), F.min("doc_id")).alias("text"))
    return C.written(_cache(spark, sf), d.select("text_hash", "text", F.expr(NOW).alias("created_at"), lit(0).cast("long").alias("hits")), 100).select("text_hash", "text", "hits")


@query(f"WITH {CACHE} SELECT c.text_hash, hits + coalesce(n, 0) AS hits, n IS NOT NULL AS accessed FROM cache c LEFT JOIN (SELECT text_hash, count(*) AS n FROM looked WHERE hit GROUP BY 1) l ON l.text_hash = c.text_hash")
def cache_hits(spark, sf):
    cache = _cache(spark, sf)
    done = C.touched(cache, C.looked_up(read(spark, sf, "documents").select("doc_id", "text"), cache), F.expr(NOW))
    return done.select("text_hash", "hits", col("last_accessed").isNotNull().alias("accessed"))


# catalogue


def _found(spark, sf) -> DataFrame:
    """Search results: customers as queries in five categories, orders as what they found."""
    o = read(spark, sf, "orders")
    k = col("o_orderkey")
    return o.select(F.concat(lit("cat"), col("o_custkey") % 5).alias("category"), col("o_custkey").alias("query_idx"), k.alias("pos"), F.concat(lit("v"), F.floor(k / 2)).alias("id"), F.concat(col("o_orderpriority"), lit(" "), k % 13).alias("title"), F.concat(lit("chan"), k % 17).alias("channel"), (k % 12000).cast("double").alias("duration"), F.when(k % 11 == 0, "private").when(k % 11 < 6, "public").alias("availability"), F.when(k % 19 == 0, "is_live").when(k % 19 < 9, "not_live").alias("live_status"))


FOUND = """found AS (SELECT 'cat' || o_custkey % 5 AS category, o_custkey AS query_idx, o_orderkey AS pos, 'v' || (o_orderkey // 2) AS id, o_orderpriority || ' ' || o_orderkey % 13 AS title, 'chan' || o_orderkey % 17 AS channel, (o_orderkey % 12000)::DOUBLE AS duration,
        CASE WHEN o_orderkey % 11 = 0 THEN 'private' WHEN o_orderkey % 11 < 6 THEN 'public' END AS availability, CASE WHEN o_orderkey % 19 = 0 THEN 'is_live' WHEN o_orderkey % 19 < 9 THEN 'not_live' END AS live_status FROM orders),
    suitable AS (SELECT * FROM found WHERE coalesce(availability, 'public') = 'public' AND coalesce(live_status, 'not_live') = 'not_live' AND duration <> 0 AND duration BETWEEN 600 AND 10800)"""
REGISTRY = """registry AS (SELECT 'v' || o_orderkey AS video_id, CASE o_orderkey % 3 WHEN 0 THEN 'processed' WHEN 1 THEN 'failed' ELSE 'skipped' END AS status, CASE o_orderkey % 4 WHEN 0 THEN 'downloaded' WHEN 1 THEN 'processing' WHEN 2 THEN 'download' ELSE 'completed' END AS stage, 'a' || o_orderkey || '.wav' AS audio_path, o_orderdate AS timestamp FROM orders)"""
WHY = "CASE WHEN contains(lower(title), 'low 1') THEN 'keyword: LOW 1' WHEN contains(lower(title), 'urgent') THEN 'keyword: urgent' WHEN contains(lower(channel), 'chan3') THEN 'channel: Chan3' END"


def _registry(spark, sf) -> DataFrame:
    o = read(spark, sf, "orders")
    k = col("o_orderkey")
    return o.select(F.concat(lit("v"), k).alias("video_id"), F.when(k % 3 == 0, "processed").when(k % 3 == 1, "failed").otherwise("skipped").alias("status"), F.when(k % 4 == 0, "downloaded").when(k % 4 == 1, "processing").when(k % 4 == 2, "download").otherwise("completed").alias("stage"), F.concat(lit("a"), k, lit(".wav")).alias("audio_path"), col("o_orderdate").cast("timestamp").alias("timestamp"))


@query(f"WITH {FOUND} SELECT pos, id, duration FROM suitable")
def candidate_filter(spark, sf):
    return L.suitable(_found(spark, sf)).select("pos", "id", "duration")


@query("SELECT o_orderkey AS pos, 'v' || o_orderkey AS id, (o_orderkey % 100)::DOUBLE AS duration FROM orders WHERE o_orderkey % 5 NOT IN (1, 2)")
def candidate_lines(spark, sf):
    k = col("o_orderkey")
    line = F.when(k % 5 == 1, "{broken").when(k % 5 == 2, '{"title": "no id"}').otherwise(F.concat(lit('{"id": "v'), k, lit('", "duration": '), k % 100, lit("}")))
    return L.candidates(read(spark, sf, "orders").select(k.alias("pos"), line.alias("value"))).select("pos", "id", "duration")


@query(f"WITH {FOUND} SELECT pos, id, {WHY} AS reason FROM found")
def candidate_exclusions(spark, sf):
    f = _found(spark, sf)
    return f.select("pos", "id", L.exclusion(col("title"), col("channel"), ["LOW 1", "urgent"], ["Chan3"]).alias("reason"))


@query(f"WITH {FOUND}, k AS (SELECT r_regionkey AS pos, substr(r_name, 1, 2) AS keyword FROM region) SELECT f.pos, f.id, arg_min(keyword, k.pos) AS reason FROM found f LEFT JOIN k ON contains(lower(title), lower(keyword)) GROUP BY f.pos, f.id")
def exclusion_join(spark, sf):
    words = read(spark, sf, "region").select(col("r_regionkey").alias("pos"), F.substring("r_name", 1, 2).alias("keyword"))
    return L.exclusion_join(_found(spark, sf).select(col("pos").alias("n"), col("pos").cast("string").alias("id"), col("id").alias("video"), "title"), words).select(col("n").alias("pos"), col("video").alias("id"), "reason")


@query(f"WITH {FOUND} SELECT pos, id FROM found QUALIFY row_number() OVER (PARTITION BY id ORDER BY pos) = 1")
def first_of_each_id(spark, sf):
    return L.first_of_each(_found(spark, sf), "id", "pos").select("pos", "id")


@query(f"WITH {FOUND} SELECT query_idx, pos FROM suitable QUALIFY row_number() OVER (PARTITION BY query_idx ORDER BY pos) <= 5")
def first_results(spark, sf):
    return L.first_n(L.suitable(_found(spark, sf)), "query_idx", 5, "pos").select("query_idx", "pos")


@query(f"""WITH {FOUND}, {REGISTRY}, a AS (SELECT * FROM suitable QUALIFY row_number() OVER (PARTITION BY category, query_idx ORDER BY pos) <= 5), b AS (SELECT * FROM a WHERE id NOT IN (SELECT video_id FROM registry WHERE status IN ('processed', 'failed')) AND {WHY} IS NULL),
    c AS (SELECT * FROM b QUALIFY row_number() OVER (PARTITION BY id ORDER BY category, query_idx, pos) = 1) SELECT category, id, pos FROM c QUALIFY row_number() OVER (PARTITION BY category ORDER BY query_idx, pos) <= 50""")
def selection(spark, sf):
    return L.selection(_found(spark, sf), _registry(spark, sf), 50, ["LOW 1", "urgent"], ["Chan3"]).select("category", "id", "pos")


@query(f"WITH {FOUND}, {REGISTRY}, r AS (SELECT video_id FROM registry WHERE status IN ('processed', 'failed')) SELECT count(*) FILTER (id NOT IN (FROM r)) AS fresh, count(*) FILTER (id IN (FROM r)) AS skipped FROM found")
def registry_anti_join(spark, sf):
    f, r = _found(spark, sf), _registry(spark, sf)
    return L.unseen(f, r).agg(F.count("*").alias("fresh")).crossJoin(L.skipped(f, r).agg(F.count("*").alias("skipped")))


@query(f"WITH {REGISTRY}, changes AS (SELECT video_id, 'processed' AS status, 'completed' AS stage, audio_path, timestamp + INTERVAL (CASE WHEN right(video_id, 1) IN ('1', '3') THEN -1 ELSE 0 END) DAYS AS timestamp FROM registry WHERE status = 'failed'), every AS (SELECT *, 0 AS new FROM registry UNION ALL SELECT *, 1 FROM changes) SELECT video_id, status, stage FROM every QUALIFY row_number() OVER (PARTITION BY video_id ORDER BY timestamp DESC, new DESC) = 1")
def registry_upsert(spark, sf):
    r = _registry(spark, sf)
    older = F.when(F.substring("video_id", -1, 1).isin("1", "3"), F.expr("timestamp - INTERVAL 1 DAY")).otherwise(col("timestamp"))
    return L.upsert(r, r.where("status = 'failed'").select("video_id", lit("processed").alias("status"), lit("completed").alias("stage"), "audio_path", older.alias("timestamp"))).select("video_id", "status", "stage")


@query(f"WITH {REGISTRY} SELECT video_id, status, stage FROM registry WHERE (status = 'failed' AND stage IN ('processing', 'downloaded') AND audio_path IN (SELECT 'a' || o_orderkey || '.wav' FROM orders WHERE o_orderkey % 4 = 0)) OR (status = 'processed' AND stage = 'downloaded')")
def retry_selection(spark, sf):
    present = read(spark, sf, "orders").where("o_orderkey % 4 = 0").select(F.concat(lit("a"), "o_orderkey", lit(".wav")).alias("path"))
    return L.retryable(_registry(spark, sf), present).select("video_id", "status", "stage")


@query("WITH m AS (SELECT o_orderkey, CASE o_orderkey % 5 WHEN 0 THEN 'ERROR: Private video' WHEN 1 THEN 'HTTP Error 403: Forbidden' WHEN 2 THEN 'Sign in to confirm your age' WHEN 3 THEN 'timed out' ELSE 'Video unavailable' END AS m FROM orders) SELECT o_orderkey, CASE WHEN m LIKE '%Private video%' OR m LIKE '%Video unavailable%' THEN 'private' WHEN m LIKE '%HTTP Error 403%' OR m LIKE '%HTTP Error 404%' THEN 'http' WHEN m LIKE '%Sign in to confirm your age%' THEN 'age' ELSE 'retry' END AS kind FROM m")
def error_kinds(spark, sf):
    k = col("o_orderkey") % 5
    m = F.when(k == 0, "ERROR: Private video").when(k == 1, "HTTP Error 403: Forbidden").when(k == 2, "Sign in to confirm your age").when(k == 3, "timed out").otherwise("Video unavailable")
    return read(spark, sf, "orders").select("o_orderkey", L.error_kind(m).alias("kind"))


@query("WITH f AS (SELECT o_orderkey, CASE WHEN o_orderkey % 9 = 0 THEN NULL ELSE o_custkey * 5 END AS size, o_orderkey % 7 <> 0 AS ok, (o_orderkey % 6)::DOUBLE / 2 AS d, o_orderkey % 5 = 0 AS corrupt FROM orders), m AS (SELECT o_orderkey, CASE WHEN size IS NULL THEN 'missing' WHEN size < 1000 THEN 'too small' WHEN NOT ok THEN 'unreadable' WHEN d < 1 THEN 'too short' WHEN corrupt THEN 'corrupt' ELSE 'ok' END AS message FROM f) SELECT message, message = 'ok' AS valid, count(*) AS files FROM m GROUP BY ALL")
def audio_checks(spark, sf):
    k = col("o_orderkey")
    c = L.audio_check(F.when(k % 9 != 0, col("o_custkey") * 5), k % 7 != 0, (k % 6).cast("double") / 2, k % 5 == 0)
    return read(spark, sf, "orders").select(c.alias("c")).groupBy(col("c.message").alias("message"), col("c.valid").alias("valid")).agg(F.count("*").alias("files"))


@query("SELECT p FROM (SELECT 'd/' || o_orderkey || CASE o_orderkey % 5 WHEN 0 THEN '.wav' WHEN 1 THEN '.wav.part' WHEN 2 THEN '.f140.m4a' WHEN 3 THEN '.tmp' ELSE '.temp.wav' END AS p FROM orders) WHERE regexp_matches(p, '\\.part$|\\.ytdl$|\\.temp(\\.|$)|\\.tmp$|\\.f[0-9]+\\.|\\.download$')")
def leftover_files(spark, sf):
    k = col("o_orderkey") % 5
    p = F.concat(lit("d/"), "o_orderkey", F.when(k == 0, ".wav").when(k == 1, ".wav.part").when(k == 2, ".f140.m4a").when(k == 3, ".tmp").otherwise(".temp.wav"))
    return L.leftovers(read(spark, sf, "orders").select(p.alias("path"))).select(col("path").alias("p"))


@query("SELECT p_partkey AS id, s_name AS path FROM (SELECT p_partkey, p_name AS t FROM part) a JOIN (SELECT s_name, 'the ' || p_name || ' ' || s_suppkey AS f FROM supplier JOIN part ON p_partkey = s_suppkey) b ON contains(f, substr(t, 1, 20)) OR contains(t, substr(f, 1, 20))")
def title_matches(spark, sf):
    parts = read(spark, sf, "part")
    files = read(spark, sf, "supplier").join(parts, col("p_partkey") == col("s_suppkey")).select(col("s_name").alias("path"), F.concat(lit("the "), "p_name", lit(" "), "s_suppkey").alias("name"))
    return L.matching_titles(parts.select(col("p_partkey").alias("id"), col("p_name").alias("title")), files)


@query("SELECT o_custkey AS id, o_orderkey % 4 AS step, 'f' || o_orderkey AS path FROM orders QUALIFY row_number() OVER (PARTITION BY o_custkey ORDER BY o_orderkey % 4, o_orderdate DESC, 'f' || o_orderkey) = 1")
def chosen_files(spark, sf):
    o = read(spark, sf, "orders").select(col("o_custkey").alias("id"), (col("o_orderkey") % 4).alias("step"), F.concat(lit("f"), "o_orderkey").alias("path"), col("o_orderdate").alias("modified"))
    return L.chosen_file(o).select("id", "step", "path")


@query("SELECT 'f' || o_orderkey AS path FROM orders WHERE o_orderkey % 2 = 0 EXCEPT SELECT 'f' || o_orderkey FROM orders WHERE o_orderkey % 3 = 0")
def new_files(spark, sf):
    o = read(spark, sf, "orders").select("o_orderkey", F.concat(lit("f"), "o_orderkey").alias("path"))
    return L.new_files(o.where("o_orderkey % 2 = 0"), o.where("o_orderkey % 3 = 0"))


@query("WITH d AS (SELECT CASE o_orderstatus WHEN 'F' THEN 'processed' WHEN 'O' THEN 'failed' ELSE 'skipped' END AS status, (o_orderkey % 5000)::DOUBLE AS a, o_orderkey % 40 AS n, (o_orderkey % 300)::DOUBLE AS p FROM orders), s AS (SELECT count(*) AS videos, count(*) FILTER (status = 'processed') AS processed, count(*) FILTER (status = 'failed') AS failed, coalesce(sum(n) FILTER (status = 'processed'), 0)::BIGINT AS segments, sum(a) FILTER (status = 'processed') AS audio_seconds, sum(p) FILTER (status = 'processed') AS p FROM d) SELECT videos, processed, failed, segments, audio_seconds, segments * 12.0::DOUBLE AS useful_seconds, round(segments * 12.0::DOUBLE / audio_seconds * 100, 2) AS efficiency, round(processed * 3600 / p, 4) AS videos_an_hour, round(p / processed, 4) AS mean_seconds FROM s")
def run_summary(spark, sf):
    k = col("o_orderkey")
    d = read(spark, sf, "orders").select(F.when(col("o_orderstatus") == "F", "processed").when(col("o_orderstatus") == "O", "failed").otherwise("skipped").alias("status"), (k % 5000).cast("double").alias("audio_seconds"), (k % 40).alias("segments"), (k % 300).cast("double").alias("processing_seconds"))
    return L.run_summary(d, 12.0)


@query("SELECT (SELECT string_agg(e, '|' ORDER BY o_orderkey) FROM (SELECT o_orderkey, 'error ' || o_orderkey AS e FROM orders ORDER BY 1 LIMIT 5)) AS shown, (SELECT greatest(count(*) - 5, 0) FROM orders) AS more")
def shown_errors(spark, sf):
    e = read(spark, sf, "orders").select(col("o_orderkey").alias("pos"), F.concat(lit("error "), "o_orderkey").alias("error"))
    return L.shown_errors(e).select(F.array_join("shown", "|").alias("shown"), col("more").cast("long").alias("more"))


# correction


def _batches(spark, sf) -> DataFrame:
    c = read(spark, sf, "conversations").select(col("conv_id").alias("group_id"), "turn", "text")
    return K.batched(c, "turn")


BATCHES = """b AS (SELECT conv_id AS group_id, (row_number() OVER w - 1) // 5 AS batch, (row_number() OVER w - 1) % 5 AS id, text FROM conversations WINDOW w AS (PARTITION BY conv_id ORDER BY turn))"""


@query(f"WITH {BATCHES} SELECT group_id, batch, count(*) AS n, 'Corrige estos textos (' || count(*) || '):\n' || string_agg(id || '. \"' || text || '\"', '\n' ORDER BY id) AS prompt FROM b GROUP BY ALL")
def batch_prompts(spark, sf):
    return K.prompts(_batches(spark, sf).select("group_id", "batch", "id", "text"))


def _answer(k: Column, text: Column) -> Column:
    good = F.to_json(F.struct(F.upper(text).alias("texto_corregido"), F.array(lit("a"), lit("b")).alias("cambios"), (k % 15 / 10).alias("confianza")))
    return F.when(k % 4 == 0, F.concat(lit("Claro: "), good, lit(" ."))).when(k % 4 == 1, good).when(k % 4 == 2, F.concat(lit('{"texto_corregido": "parte '), k.cast("string"), lit('", "cambios": ['))).otherwise("nada")


ANSWERED = """p AS (SELECT p_partkey, p_name, CASE WHEN p_partkey % 4 < 2 THEN upper(p_name) WHEN p_partkey % 4 = 2 THEN 'parte ' || p_partkey ELSE p_name END AS text, CASE WHEN p_partkey % 4 < 2 THEN 2 WHEN p_partkey % 4 = 2 THEN 1 ELSE 0 END AS changes,
    CASE WHEN p_partkey % 4 < 2 THEN least(1.0::DOUBLE, (p_partkey % 15)::DOUBLE / 10) WHEN p_partkey % 4 = 2 THEN 0.5::DOUBLE ELSE 0.0::DOUBLE END AS confidence, p_partkey % 4 < 3 AS success FROM part)"""


def _answered(spark, sf) -> DataFrame:
    p = read(spark, sf, "part").select("p_partkey", "p_name", _answer(col("p_partkey"), col("p_name")).alias("answer"))
    return p.withColumn("r", K.parsed(col("answer"), col("p_name")))


@query(f"WITH {ANSWERED} SELECT p_partkey, success, text, changes, round(confidence, 6) AS confidence FROM p")
def answer_parsing(spark, sf):
    return _answered(spark, sf).select("p_partkey", "r.success", "r.text", F.size("r.changes").cast("long").alias("changes"), F.round("r.confidence", 6).alias("confidence"))


GATED = f"""{ANSWERED}, g AS (SELECT p_partkey, p_name, text, changes, confidence, NOT success AS llm_error, success AND confidence >= 0.7::DOUBLE AS ok FROM p)"""


def _gated(spark, sf) -> DataFrame:
    rows = _answered(spark, sf).select("p_partkey", col("p_name").alias("text"), col("r.text").alias("corrected"), "r.changes", "r.confidence", F.when(~col("r.success"), "failed").alias("error"))
    return K.gated(rows)


@query(f"WITH {GATED} SELECT p_partkey, CASE WHEN ok THEN text ELSE p_name END AS final_text, ok AND text <> p_name AS llm_applied, NOT llm_error AND confidence < 0.7::DOUBLE AS llm_low_confidence, llm_error FROM g")
def confidence_gate(spark, sf):
    return _gated(spark, sf).select("p_partkey", "final_text", "llm_applied", "llm_low_confidence", "llm_error")


@query(f"WITH {GATED} SELECT count(*) FILTER (ok AND text <> p_name) AS corrected, count(*) FILTER (llm_error) AS failed, count(*) FILTER (NOT llm_error AND confidence < 0.7::DOUBLE) AS low_confidence, sum(changes)::BIGINT AS changes, round(avg(confidence) FILTER (NOT llm_error), 6) AS mean_confidence FROM g")
def correction_figures(spark, sf):
    return K.correction_figures(_gated(spark, sf))


@query(f"WITH {BATCHES} SELECT group_id, batch, id, CASE WHEN id % 3 = 0 THEN text ELSE 'c' || id END AS corrected, round(CASE WHEN id % 3 = 0 THEN 0.0 ELSE 0.9 END::DOUBLE, 6) AS confidence, CASE WHEN id % 3 = 0 THEN 'missing_in_batch' END AS error FROM b")
def batch_matching(spark, sf):
    b = _batches(spark, sf).select("group_id", "batch", "id", "text")
    item = F.concat(lit('{"id": '), col("id").cast("string"), lit(', "texto_corregido": "c'), col("id").cast("string"), lit('", "cambios": [], "confianza": 0.9}'))
    twice = F.concat(item, lit(", "), F.regexp_replace(item, '"c', '"second'))
    answers = b.groupBy("group_id", "batch").agg(F.concat(lit('{"correcciones": ['), F.array_join(F.collect_list(F.when(col("id") % 3 != 0, twice)), ", "), lit("]}")).alias("response"))
    return K.matched(b, answers).select("group_id", "batch", "id", "corrected", F.round("confidence", 6).alias("confidence"), "error")


def _shout(system: str, prompt: str) -> str:
    """A stand-in for a model: it answers in capitals, with a comma too many."""
    import json
    import re

    items = re.findall(r'^(\d+)\. "(.*)"$', prompt, re.M)
    return json.dumps({"correcciones": [{"id": int(i), "texto_corregido": t.upper(), "cambios": ["upper"], "confianza": 0.9} for i, t in items]}).replace("}]", "},]")


def _names(spark, sf) -> DataFrame:
    return spread(read(spark, sf, "part").select(col("p_partkey").alias("id"), col("p_name").alias("text")), "id")


@query("SELECT p_partkey AS id, upper(p_name) AS corrected, 0.9::DOUBLE AS confidence, NULL::VARCHAR AS error FROM part")
def model_correction(spark, sf):
    return K.corrected(_names(spark, sf), _shout).select("id", "corrected", "confidence", "error")


@query("WITH c AS (SELECT DISTINCT md5(lower(p_name)) AS h FROM part WHERE p_partkey % 3 = 0) SELECT p_partkey AS id, CASE WHEN md5(lower(p_name)) IN (FROM c) THEN 'cached' ELSE upper(p_name) END AS final_text, md5(lower(p_name)) IN (FROM c) AS hit FROM part")
def cached_correction(spark, sf):
    p = read(spark, sf, "part").select(col("p_partkey").alias("id"), col("p_name").alias("text"))
    cache = p.where("id % 3 = 0").select(T.text_hash(col("text")).alias("text_hash")).distinct().select("text_hash", lit("cached").alias("text"), F.array(lit("x")).alias("changes"), lit(0.95).alias("confidence"))
    return speech.corrected_texts(p, cache, _shout)[0].select("id", "final_text", "hit")


# metadata


def _worded(spark, sf) -> DataFrame:
    t = turns(spark, sf)
    c = read(spark, sf, "conversations").select(col("conv_id").alias("podcast_id"), col("turn").alias("seg_idx"), F.when(col("turn") % 4 == 2, " \n").otherwise(col("text")).alias("text"), lit("es").alias("language")).where("seg_idx % 5 <> 3")
    s = t.select("podcast_id", col("turn_idx").alias("seg_idx"), "start", "end", F.concat(lit("SPEAKER_"), F.length("speaker")).alias("speaker"), F.concat(lit("s"), "turn_idx", lit(".wav")).alias("path"))
    return M.with_transcripts(s, c)


@query(f"""WITH {TURNS}, rows_ AS (SELECT t.podcast_id, t.turn_idx, a, z, speaker, row_number() OVER (PARTITION BY t.podcast_id ORDER BY t.turn_idx) - 1 AS n, CASE WHEN t.turn_idx % 5 = 3 THEN '' WHEN t.turn_idx % 4 = 2 THEN ' ' ELSE c.text END AS text FROM turns t JOIN conversations c ON c.conv_id = t.podcast_id AND c.turn = t.turn_idx)
    SELECT text, 's' || turn_idx || '.wav' AS path, length(speaker)::INT AS speaker, 'SPEAKER_' || length(speaker) AS speaker_label, a AS "start", z AS "end", z - a AS duration, 'es' AS language, podcast_id::VARCHAR AS podcast_id, format('seg_{{:04d}}', n) AS segment_id FROM rows_ WHERE length(trim(text)) > 0""")
def segment_metadata(spark, sf):
    return M.metadata(_worded(spark, sf).withColumn("podcast_id", col("podcast_id").cast("string")))


def _cleanable(spark, sf) -> DataFrame:
    k = col("o_orderkey")
    return read(spark, sf, "orders").select(col("o_custkey").alias("podcast_id"), k.alias("pos"), F.concat(lit("d/seg_"), k, F.when(k % 3 == 0, F.concat(lit("_SPEAKER_GLOBAL_"), k % 7)).when(k % 3 == 1, F.concat(lit("_SPK_"), k % 90)).otherwise(""), lit(".wav")).alias("path"), F.when(k % 4 == 0, "SPEAKER_00").when(k % 4 == 1, F.concat(lit("SPEAKER_"), k % 100)).when(k % 4 == 2, "").alias("speaker_label"))


CLEANED = """r AS (SELECT o_custkey AS podcast_id, o_orderkey AS k, row_number() OVER (PARTITION BY o_custkey ORDER BY o_orderkey) - 1 AS i FROM orders),
    n AS (SELECT *, CASE k % 4 WHEN 1 THEN k % 100 ELSE CASE k % 3 WHEN 0 THEN k % 7 WHEN 1 THEN k % 90 END END AS num FROM r), kept AS (SELECT podcast_id, k AS pos, format('SPK_{:02d}', num) AS speaker_label, format('seg_{:04d}_SPK_{:02d}', i, num) AS segment_id FROM n WHERE num IS NOT NULL AND k % 11 <> 0)"""


@query(f"WITH {CLEANED} SELECT * FROM kept")
def segment_cleanup(spark, sf):
    return M.cleaned(_cleanable(spark, sf), col("pos") % 11 != 0).select("podcast_id", "pos", "speaker_label", "segment_id")


@query(f"WITH {CLEANED} SELECT r.podcast_id, count(pos) AS kept, count(*) - count(pos) AS removed, count(pos) AS renamed FROM r LEFT JOIN kept ON pos = k GROUP BY 1")
def cleanup_counts(spark, sf):
    rows = _cleanable(spark, sf)
    return M.cleanup_counts(rows, M.cleaned(rows, col("pos") % 11 != 0))


@query(f"WITH {TURNS} SELECT podcast_id, speaker, count(*) AS segments, round(sum(z - a) / 1000, 2) AS seconds FROM turns GROUP BY ALL")
def speaker_figures(spark, sf):
    return M.speaker_figures(turns(spark, sf).withColumn("duration", (col("end") - col("start")) / 1000))


@query(f"WITH {TURNS} SELECT podcast_id, count(*) AS segments, count(DISTINCT speaker) AS speakers, sum(z - a)::BIGINT AS seconds FROM turns GROUP BY 1")
def recording_metrics(spark, sf):
    t = turns(spark, sf).withColumn("duration", col("end") - col("start"))
    seen = I.review_counts(I.reviewed(windows(t), t))
    return M.metrics(t, seen).select("podcast_id", "result.*")


@query("WITH e AS (SELECT c_custkey, list_filter([CASE WHEN c_custkey % 6 = 0 THEN 'text_present' END, CASE WHEN c_acctbal <= 0 THEN 'duration_positive' END, CASE WHEN c_custkey % 10 = 0 THEN 'start_not_negative' END, CASE WHEN c_custkey % 10 - 1 + c_acctbal < 0 THEN 'end_not_negative' END, CASE WHEN c_acctbal <= 0 THEN 'end_after_start' END], lambda x: x IS NOT NULL) AS e FROM customer) SELECT c_custkey, array_to_string(e, ',') AS errors, len(e) = 0 AS is_valid FROM e")
def constraint_validation(spark, sf):
    k = col("c_custkey")
    start = (k % 10 - 1).cast("double")
    rows = read(spark, sf, "customer").select("c_custkey", F.when(k % 6 != 0, "hola").otherwise(" ").alias("text"), col("c_acctbal").alias("duration"), start.alias("start"), (start + col("c_acctbal")).alias("end"))
    return M.validated(rows, M.segment_rules()).select("c_custkey", F.array_join("errors", ",").alias("errors"), "is_valid")


@query(f"WITH {TURNS}, a AS (SELECT podcast_id, count(*) AS n FROM turns WHERE podcast_id % 2 = 0 GROUP BY 1), b AS (SELECT podcast_id, count(*) AS n FROM turns WHERE podcast_id % 2 = 1 GROUP BY 1) FROM a UNION ALL FROM b")
def combined_metadata(spark, sf):
    t = turns(spark, sf)
    return M.combined([t.where("podcast_id % 2 = 0"), t.where("podcast_id % 2 = 1")]).groupBy("podcast_id").agg(F.count("*").alias("n"))


@query()
def recording_to_metadata(spark, sf):
    """The whole plan, from turns and transcripts to the ten columns."""
    t = turns(spark, sf)
    words = read(spark, sf, "conversations").select(col("conv_id").alias("podcast_id"), col("turn").alias("seg_idx"), "text", lit("es").alias("language"))
    return speech.recording_to_metadata(t.drop("duration"), lengths(t), words, RULES, 15 * SECOND, 10 * SECOND, 2, 0.8, 5 * SECOND)


# embeddings

NORM = "sqrt(list_sum([x * x FOR x IN {e}]))"
EMB = f"e AS (SELECT vec_id, label, embedding::DOUBLE[] AS v FROM embeddings), u AS (SELECT *, [x / {NORM.format(e='v')} FOR x IN v] AS w FROM e)"


@query(f"WITH {EMB} SELECT vec_id, round(list_sum(w), 6) AS total, round({NORM.format(e='w')}, 6) AS norm, len(v) > 0 AS valid FROM u")
def unit_vectors(spark, sf):
    e = read(spark, sf, "embeddings")
    u = V.unit(col("embedding"))
    return e.select("vec_id", F.round(F.aggregate(u, lit(0.0), lambda a, x: a + x), 6).alias("total"), F.round(V.norm(u), 6).alias("norm"), V.valid(col("embedding")).alias("valid"))


BANKED = f"""{EMB}, bank AS (SELECT label, [x / sqrt(list_sum([y * y FOR y IN m])) FOR x IN m] AS b FROM (SELECT label, list(a ORDER BY i) AS m FROM (SELECT label, i, avg(w[i]) AS a FROM (SELECT label, w, unnest(range(1, len(w) + 1)) AS i FROM u) GROUP BY ALL) GROUP BY 1))"""


def _bank(spark, sf) -> DataFrame:
    e = read(spark, sf, "embeddings").select("label", V.unit(col("embedding")).alias("embedding"))
    return P.mean_embedding(e, "label")


@query(f"WITH {BANKED} SELECT label, round(list_sum(b), 6) AS total, round(b[1], 6) AS first FROM bank")
def mean_embeddings(spark, sf):
    return _bank(spark, sf).select("label", F.round(F.aggregate("embedding", lit(0.0), lambda a, x: a + x), 6).alias("total"), F.round(F.element_at("embedding", 1), 6).alias("first"))


@query(f"""WITH {BANKED}, s AS (SELECT vec_id, bank.label AS l, list_sum([w[i] * b[i] FOR i IN range(1, len(w) + 1)]) AS c FROM u, bank), m AS (SELECT vec_id, max(c) AS c, arg_max(l, c) AS l FROM s GROUP BY 1)
    SELECT vec_id AS query_id, CASE WHEN c >= 0.5 THEN l::VARCHAR END AS speaker_id, round(c, 6) AS score FROM m""")
def nearest_speakers(spark, sf):
    bank = _bank(spark, sf).select(col("label").cast("string").alias("speaker_id"), "embedding")
    q = read(spark, sf, "embeddings").select(col("vec_id").alias("query_id"), "embedding")
    return P.nearest(q, bank, 0.5).withColumn("score", F.round("score", 6))


@query(f"WITH {TURNS}, s AS (SELECT *, max((duration >= 20000)::INT) OVER (PARTITION BY podcast_id, speaker) AS any_long FROM turns WHERE duration >= 3000), r AS (SELECT *, row_number() OVER (PARTITION BY podcast_id, speaker ORDER BY duration DESC, turn_idx) AS k FROM s WHERE duration >= 20000 OR any_long = 0) SELECT podcast_id, speaker, turn_idx FROM r WHERE k <= 2 OR any_long = 0")
def longest_turns(spark, sf):
    return P.longest(turns(spark, sf), 2, 20 * SECOND, 3 * SECOND).select("podcast_id", "speaker", "turn_idx")


@query(f"WITH {TURNS} SELECT podcast_id, turn_idx, CASE WHEN speaker = 'user' AND podcast_id % 2 = 0 THEN 'SPEAKER_GLOBAL_001' ELSE speaker END AS speaker, speaker AS speaker_local FROM turns")
def global_ids(spark, sf):
    t = turns(spark, sf)
    ids = t.where("speaker = 'user' and podcast_id % 2 = 0").select("podcast_id", "speaker").distinct().withColumn("global_id", lit("SPEAKER_GLOBAL_001"))
    return P.with_global_ids(t, ids).select("podcast_id", "turn_idx", "speaker", "speaker_local")


@query()
def speaker_clustering(spark, sf):
    """The online fold over all embeddings in order, tested against plain Python."""
    e = read(spark, sf, "embeddings").select(F.floor(col("vec_id") / 5).alias("podcast_id"), col("vec_id").cast("string").alias("speaker"), "embedding", col("vec_id").alias("seq"))
    return P.clustered(e, threshold=0.5).withColumn("score", F.round("score", 6))


@query(f"WITH {EMB}, p AS (SELECT a.vec_id, [(a.w[i] * 3 + b.w[i]) / 4 FOR i IN range(1, len(a.w) + 1)] AS m FROM u a JOIN u b ON b.vec_id = a.vec_id + 1) SELECT vec_id, round(m[1] / {NORM.format(e='m')}, 6) AS first, round(list_sum(m) / {NORM.format(e='m')}, 6) AS total FROM p")
def running_means(spark, sf):
    e = read(spark, sf, "embeddings").select("vec_id", V.unit(col("embedding")).alias("a"))
    nxt = e.select((col("vec_id") - 1).alias("vec_id"), col("a").alias("b"))
    m = V.running_mean(col("a"), lit(3), col("b"))
    return e.join(nxt, "vec_id").select("vec_id", m.alias("m")).select("vec_id", F.round(F.element_at("m", 1), 6).alias("first"), F.round(F.aggregate("m", lit(0.0), lambda a, x: a + x), 6).alias("total"))


# sounds, registries, glossaries and runs


def _sounds(spark, sf) -> DataFrame:
    """For each part a second or more of even sound at 100 samples a second; every seventh is no sound, every eleventh of a format without decoder."""

    @F.pandas_udf("binary")
    def made(keys: pd.Series) -> pd.Series:
        return keys.map(lambda k: b"nothing to hear" if k % 7 == 0 else b"ID3" + bytes(2000) if k % 11 == 0 else S.encode_wav(np.full(100 * (1 + k % 3), 0.5), 100))

    return spread(read(spark, sf, "part").select("p_partkey"), "p_partkey").select("p_partkey", F.concat(lit("s"), "p_partkey").alias("path"), made("p_partkey").alias("content"))


KIND = "CASE WHEN p_partkey % 7 = 0 THEN 'noise' WHEN p_partkey % 11 = 0 THEN 'mp3' ELSE 'wav' END"
SOUNDS = f"sounds AS (SELECT p_partkey AS k, 's' || p_partkey AS path, {KIND} AS kind, 1 + p_partkey % 3 AS sec FROM part)"


@query(f"WITH {SOUNDS} SELECT path, nullif(kind, 'noise') AS format, kind = 'wav' AS readable, CASE WHEN kind = 'wav' THEN sec::DOUBLE END AS seconds, kind = 'noise' AS corrupt FROM sounds")
def audio_probe(spark, sf):
    return R.probed(_sounds(spark, sf)).select("path", "format", "readable", "seconds", "corrupt")


@query(f"WITH {SOUNDS} SELECT path, CASE WHEN kind = 'wav' THEN 44 + 2 * 50 * sec END AS bytes, kind <> 'wav' AS failed FROM sounds")
def audio_conversion(spark, sf):
    """Decoded, mono, at half the rate, as WAV."""
    return S.converted_files(_sounds(spark, sf), 50).select("path", F.octet_length("content").cast("long").alias("bytes"), col("error").isNotNull().alias("failed"))


@query(f"WITH {SOUNDS} SELECT path, kind = 'wav' AS ok, CASE WHEN kind = 'wav' THEN 44 + 2 * 16000 * sec END AS bytes FROM sounds")
def audio_repair(spark, sf):
    """Files that end too early, read as far as they go."""
    cut = _sounds(spark, sf).withColumn("content", F.when(col("p_partkey") % 2 == 0, F.expr("concat(substring(content, 1, 40), X'FFFFFF7F', substring(content, 45, octet_length(content)))")).otherwise(col("content")))
    return R.repaired(cut).select("path", "ok", F.octet_length("content").cast("long").alias("bytes"))


@query(f"WITH {SOUNDS} SELECT count(*) AS files, 0 AS valid, count(*) FILTER (kind = 'wav') AS repaired, count(*) FILTER (kind <> 'wav') AS bad FROM sounds")
def audio_validation(spark, sf):
    """The report of all files, of which short ones are written anew at a higher rate."""
    return L.validation_summary(R.validated_files(_sounds(spark, sf)))


@query(f"WITH {SOUNDS} SELECT path, CASE WHEN kind = 'wav' THEN -23.0::DOUBLE END AS loudness, CASE WHEN kind = 'wav' THEN round(0.076657::DOUBLE, 4) END AS peak, CASE WHEN kind = 'wav' THEN sec::DOUBLE END AS duration, kind <> 'wav' AS failed FROM sounds")
def audio_normalisation(spark, sf):
    return S.normalised_files(_sounds(spark, sf)).select("path", F.round("loudness", 2).alias("loudness"), F.round("peak", 4).alias("peak"), "duration", col("error").isNotNull().alias("failed"))


@query(f"WITH {SOUNDS} SELECT k AS podcast_id, seg AS seg_idx, CASE WHEN kind = 'wav' THEN 44 + 2 * 100 END AS bytes, kind <> 'wav' AS failed FROM (SELECT *, unnest(range(0, sec)) AS seg FROM sounds)")
def audio_segments(spark, sf):
    """Each second of each recording as a file."""
    x = _sounds(spark, sf)
    segments = x.select(col("p_partkey").cast("string").alias("podcast_id"), F.explode(F.sequence(lit(0).cast("long"), col("p_partkey") % 3)).alias("seg_idx")).withColumn("start", col("seg_idx").cast("double")).withColumn("end", col("start") + 1)
    out = S.cut_files(segments, x.select(col("p_partkey").cast("string").alias("podcast_id"), "content"))
    return out.select(col("podcast_id").cast("long").alias("podcast_id"), "seg_idx", F.octet_length("content").cast("long").alias("bytes"), col("error").isNotNull().alias("failed"))


def _said(content: bytes, language: str = "en") -> dict:
    return {"text": f"{len(S.decode(content)[0])} samples", "language": language}


@query(f"WITH {SOUNDS} SELECT path, CASE WHEN kind = 'wav' THEN 100 * sec || ' samples' ELSE '' END AS text, CASE WHEN kind = 'wav' THEN 'es' ELSE 'unknown' END AS language, kind <> 'wav' AS failed FROM sounds")
def audio_transcripts(spark, sf):
    """By a stand-in for a model, with an option of its own."""
    return S.transcribed(_sounds(spark, sf), _said, language="es").select("path", "text", "language", col("error").isNotNull().alias("failed"))


def _turns_of(content: bytes) -> list[dict]:
    """A stand-in for a diarizer: it knows two seconds of sound, finds nothing in one, and fails else."""
    n = len(S.decode(content)[0]) // 100
    if n == 3:
        raise RuntimeError("too long")
    return [{"start": 0, "end": 1, "speaker": "A"}, {"start": 1, "end": 2, "speaker": "B"}] if n == 2 else []


@query(f"""WITH {SOUNDS} SELECT path AS podcast_id, t.turn_idx, t.s AS "start", t.e AS "end", t.speaker, t.method FROM sounds, (VALUES ('model', 2, 0, 0.0, 1.0, 'A'), ('model', 2, 1, 1.0, 2.0, 'B'), ('energy', 1, 0, 0.0, 1.0, 'SPEAKER_00'), ('energy', 3, 0, 0.0, 3.0, 'SPEAKER_00'), ('none', 0, 0, 0.0, 0.0, 'SPEAKER_00')) t(method, n, turn_idx, s, e, speaker) WHERE n = CASE WHEN kind = 'wav' THEN sec ELSE 0 END""".replace("t.turn_idx", "t.turn_idx::BIGINT AS turn_idx").replace("t.s AS", "t.s::DOUBLE AS").replace("t.e AS", "t.e::DOUBLE AS"))
def audio_diarization(spark, sf):
    """A model first; where it fails or finds nothing turns by energy; where there is no sound one turn."""
    return S.diarized(_sounds(spark, sf).select(col("path").alias("podcast_id"), "content"), _turns_of).drop("error")


#: Cuts of even sound: the first place that may be quietest, a second before 15.
CUTS = """cuts AS (SELECT * FROM (VALUES (40, 0, 0, 14), (40, 1, 14, 28), (40, 2, 28, 40), (41, 0, 0, 14), (41, 1, 14, 28), (41, 2, 28, 41), (42, 0, 0, 14), (42, 1, 14, 28), (42, 2, 28, 42), (43, 0, 0, 14), (43, 1, 14, 28), (43, 2, 28, 43), (44, 0, 0, 14), (44, 1, 14, 28), (44, 2, 28, 42)) t(total, seg_idx, s, e))"""


@query(f"""WITH {CUTS} SELECT s_suppkey AS podcast_id, seg_idx::BIGINT AS seg_idx, s::DOUBLE AS "start", e::DOUBLE AS "end" FROM supplier JOIN cuts ON total = 40 + s_suppkey % 5""")
def quiet_cuts(spark, sf):
    @F.pandas_udf("binary")
    def made(keys: pd.Series) -> pd.Series:
        return keys.map(lambda k: S.encode_wav(np.full(100 * (40 + k % 5), 0.5), 100))

    x = spread(read(spark, sf, "supplier").select("s_suppkey"), "s_suppkey").select(col("s_suppkey").alias("podcast_id"), made("s_suppkey").alias("content"))
    t = x.select("podcast_id", lit(0).alias("turn_idx"), lit(0.0).alias("start"), (lit(40.0) + col("podcast_id") % 5).alias("end"), lit("A").alias("speaker"))
    return S.split_turns(t, x).select("podcast_id", "seg_idx", "start", "end")


@query(f"WITH {TURNS}, s AS (SELECT podcast_id, speaker, sum(duration)::BIGINT AS total, min(turn_idx) AS first FROM turns GROUP BY ALL) SELECT podcast_id, arg_max(speaker, total * 1000000 - first) AS dominant, round(max(total) / sum(total), 9) AS purity, count(*) AS speakers FROM s GROUP BY 1")
def dominant_by_duration(spark, sf):
    """Of whole recordings, by the durations that turns carry."""
    t = turns(spark, sf).withColumn("seg_idx", lit(0))
    return I.purity(t, "duration").select("podcast_id", "dominant", F.round("purity", 9).alias("purity"), "speakers")


@query(f"""WITH {TURNS}, seen AS (SELECT w.podcast_id, w.seg_idx, s, e, dominant, purity, coalesce(speakers, 0) AS n FROM windows w LEFT JOIN purity p ON p.podcast_id = w.podcast_id AND p.seg_idx = w.seg_idx),
    long AS (SELECT o.podcast_id, o.seg_idx, turn_idx, s + o_start AS a FROM overlap o JOIN seen x ON x.podcast_id = o.podcast_id AND x.seg_idx = o.seg_idx WHERE n > 1 AND o >= 5000),
    pieces AS (SELECT podcast_id, seg_idx, a, turn_idx, true AS split FROM long UNION ALL SELECT podcast_id, seg_idx, s, 0, true FROM seen x WHERE n > 1 AND NOT EXISTS (SELECT 1 FROM long l WHERE l.podcast_id = x.podcast_id AND l.seg_idx = x.seg_idx) UNION ALL SELECT podcast_id, seg_idx, s, 0, false FROM seen WHERE n <= 1 AND coalesce(purity, 1) >= 0.8)
    SELECT podcast_id, segment, CASE WHEN split AND segment % 3 > 0 THEN 'again ' || segment ELSE 'first' END AS text, CASE WHEN split AND segment % 3 > 0 THEN 'fr' ELSE 'es' END AS language FROM (SELECT *, row_number() OVER (PARTITION BY podcast_id ORDER BY seg_idx, a, turn_idx) - 1 AS segment FROM pieces)""")
def review_transcribed_again(spark, sf):
    """Segments that review split are transcribed anew, where that gives a text."""
    t = turns(spark, sf)
    seen = I.review(windows(t), t, 1, 0.8, 5 * SECOND, 60 * SECOND).withColumn("text", lit("first")).withColumn("language", lit("es"))
    again = seen.where("segment % 3 > 0").select("podcast_id", "segment", F.concat(lit("again "), "segment").alias("text"), lit("fr").alias("language"))
    return I.transcribed_again(seen, again).select("podcast_id", "segment", "text", "language")


@query("SELECT r_name AS name, n.pos, n.query FROM (SELECT r_regionkey, r_name FROM region WHERE r_regionkey % 3 <> 1) r JOIN (SELECT n_regionkey, n_name AS query, row_number() OVER (PARTITION BY n_regionkey ORDER BY n_name) - 1 AS pos FROM nation) n ON n_regionkey = r_regionkey")
def enabled_categories(spark, sf):
    names = read(spark, sf, "nation").groupBy("n_regionkey").agg(F.array_sort(F.collect_list("n_name")).alias("queries"))
    k = col("r_regionkey") % 3
    c = read(spark, sf, "region").join(names, col("n_regionkey") == col("r_regionkey")).select(col("r_name").alias("name"), F.when(k == 0, lit(True)).when(k == 1, lit(False)).alias("enabled"), "queries", lit(None).cast("array<string>").alias("exclude_keywords"))
    return L.enabled(c).select("name", col("pos").cast("long").alias("pos"), "query")


@query(f"WITH {CACHE}, n AS (SELECT DISTINCT 'n' || p_partkey AS text_hash FROM part) SELECT (SELECT count(*) FROM looked WHERE hit) AS hits, (SELECT count(*) FROM looked WHERE NOT hit) AS misses, (SELECT round(count(*) FILTER (hit) * 100.0::DOUBLE / count(*), 2) FROM looked) AS hit_rate, (SELECT count(*) FROM n) AS writes, (SELECT greatest(count(*) - 500, 0) FROM (SELECT text_hash FROM cache UNION SELECT text_hash FROM n)) AS evictions, (SELECT least(count(*), 500) FROM (SELECT text_hash FROM cache UNION SELECT text_hash FROM n)) AS entries, 500 AS max_entries")
def cache_run(spark, sf):
    cache = _cache(spark, sf)
    new = read(spark, sf, "part").select(F.concat(lit("n"), "p_partkey").alias("text_hash")).distinct()
    return C.run_figures(C.looked_up(read(spark, sf, "documents").select("doc_id", "text"), cache), cache, new, 500)


@query(f"WITH {CACHE} SELECT doc_id, hit FROM looked")
def cache_contains(spark, sf):
    return C.contains(read(spark, sf, "documents").select("doc_id", "text"), _cache(spark, sf)).select("doc_id", "hit")


def _fetch(url: str) -> bytes:
    """A stand-in for a source of media."""
    k = int(url.rsplit("/", 1)[1])
    if k % 5 == 0:
        raise RuntimeError("HTTP Error 404: Not Found")
    if k % 5 == 1:
        raise RuntimeError("timed out")
    return b"x" * k


@query("SELECT count(*) AS downloads, count(*) FILTER (p_partkey % 5 > 1) AS succeeded, count(*) FILTER (p_partkey % 5 <= 1) AS failed, count(*) FILTER (p_partkey % 5 = 0) AS terminal, sum(CASE WHEN p_partkey % 5 = 1 THEN 3 ELSE 1 END)::BIGINT AS tries FROM part")
def download_figures(spark, sf):
    """A batch of downloads: tried again unless that can't help."""
    got = L.downloaded(spread(read(spark, sf, "part").select("p_partkey"), "p_partkey").select(col("p_partkey").cast("string").alias("id"), F.concat(lit("https://x.example/"), "p_partkey").alias("url")), _fetch, keep=False)
    return L.download_summary(got)


@query("SELECT label AS podcast_id, count(*) FILTER (vec_id % 7 <> 0 AND vec_id % 11 <> 0) AS matched, count(*) FILTER (vec_id % 7 = 0) AS created FROM embeddings GROUP BY 1")
def bank_figures(spark, sf):
    met = read(spark, sf, "embeddings").select(col("label").alias("podcast_id"), (col("vec_id") % 7 == 0).alias("created"), F.when(col("vec_id") % 11 != 0, "x").alias("global_id"))
    return P.bank_counts(met)


@query(f"WITH {PARTS}, o AS (SELECT error, min(correction) AS correction FROM base GROUP BY 1) SELECT row_number() OVER (ORDER BY error) AS place, error, correction FROM o")
def glossary_sorted(spark, sf):
    """Read back from the file of rules in order, whose lines tell the order."""
    from pyspark.sql import Window

    a, _ = _rules(spark, sf)
    path = f"{R.shared_folder(spark)}/glossary-{uuid.uuid4()}"
    R.write_glossary(G.sorted_rules(a.groupBy("error").agg(F.min("correction").alias("correction"))), path)
    lines = spark.read.schema("error string, correction string").json(path).withColumn("line", F.monotonically_increasing_id())
    return lines.select(F.row_number().over(Window.orderBy("line")).cast("long").alias("place"), "error", "correction")


@query("SELECT c_custkey, format('SPEAKER_GLOBAL_{:03d}', rank) AS global_id, first <> c_custkey AS matched FROM (SELECT *, dense_rank() OVER (ORDER BY first) AS rank FROM (SELECT c_custkey, min(c_custkey) OVER (PARTITION BY c_nationkey) AS first FROM customer))")
def online_speakers(spark, sf):
    """The online fold where it is known what it must give: voices that are equal or at right angles."""
    one_hot = F.transform(F.sequence(lit(0), lit(24)), lambda i: F.when(i == col("c_nationkey"), lit(2.0)).otherwise(0.0))
    rows = read(spark, sf, "customer").select(col("c_custkey").alias("podcast_id"), lit("S").alias("speaker"), one_hot.alias("embedding"), col("c_custkey").alias("seq"))
    return P.clustered(rows).select(col("podcast_id").alias("c_custkey"), "global_id", (~col("created")).alias("matched"))


@query("SELECT r_regionkey, 'own-' || (1 + r_regionkey) AS global_id FROM region")
def speaker_ids(spark, sf):
    """Ids of the caller's making."""
    one_hot = F.transform(F.sequence(lit(0), lit(4)), lambda i: F.when(i == col("r_regionkey"), lit(1.0)).otherwise(0.0))
    rows = read(spark, sf, "region").select(col("r_regionkey").cast("long").alias("podcast_id"), lit("S").alias("speaker"), one_hot.alias("embedding"), col("r_regionkey").alias("seq"))
    return P.clustered(rows, made=lambda n: f"own-{n}").select(col("podcast_id").cast("int").alias("r_regionkey"), "global_id")


@query(f"WITH {REGISTRY} SELECT video_id, CASE WHEN ok THEN 'processed' ELSE status END AS status, CASE WHEN ok THEN 'completed' ELSE stage END AS stage, audio_path, CASE WHEN ok THEN 12::BIGINT END AS segments, ok AS retried FROM (SELECT *, status = 'failed' AND substr(video_id, 2)::BIGINT % 2 = 0 AS ok FROM registry)")
def retries(spark, sf):
    """Failed recordings tried again: every second goes well, the others stay as they were; nothing else of a row is lost."""
    r = _registry(spark, sf).withColumn("segments", lit(None).cast("long")).withColumn("error", lit("e")).withColumn("retried", lit(False))
    results = r.where("status = 'failed'").select("video_id", (F.substring("video_id", 2, 20).cast("long") % 2 == 0).alias("ok"), lit(12).cast("long").alias("segments"), lit("again").alias("error"), F.expr("timestamp + INTERVAL 1 DAY").alias("timestamp"))
    return L.retried(r, results).select("video_id", "status", "stage", "audio_path", "segments", "retried")


@query(f"""WITH {FOUND}, {REGISTRY}, a AS (SELECT * FROM suitable QUALIFY row_number() OVER (PARTITION BY category, query_idx ORDER BY pos) <= 5), b AS (SELECT * FROM a WHERE id NOT IN (SELECT video_id FROM registry WHERE status IN ('processed', 'failed')) AND {WHY} IS NULL),
    c AS (SELECT * FROM b QUALIFY row_number() OVER (PARTITION BY id ORDER BY category, query_idx, pos) = 1), d AS (SELECT id, substr(id, 2)::BIGINT AS k FROM c QUALIFY row_number() OVER (PARTITION BY category ORDER BY query_idx, pos) <= 50)
    SELECT id, CASE WHEN k % 5 > 1 AND k % 3 > 0 THEN 'processed' ELSE 'failed' END AS status, CASE WHEN k % 5 <= 1 THEN 'download' WHEN k % 3 = 0 THEN 'processing' ELSE 'completed' END AS stage, CASE WHEN k % 5 = 0 THEN 'HTTP Error 404: Not Found' WHEN k % 5 = 1 THEN 'timed out' WHEN k % 3 = 0 THEN 'no sound' END AS error, CASE WHEN k % 5 > 1 AND k % 3 > 0 THEN k END AS segments FROM d""")
def orchestrated_run(spark, sf):
    """Search results to what came of them: selection, downloads, processing, with failures of each as rows."""

    def work(got: DataFrame) -> DataFrame:
        k = F.octet_length("content").cast("long")
        return got.select("id", F.when(k % 3 > 0, k).alias("segments"), lit(60.0).alias("audio_seconds"), lit(1.0).alias("processing_seconds"), F.when(k % 3 == 0, "no sound").alias("error"))

    found = _found(spark, sf).withColumn("url", F.concat(lit("https://x.example/"), F.substring("id", 2, 20)))
    details, _ = speech.run(found, _registry(spark, sf), _fetch, work, 50, ["LOW 1", "urgent"], ["Chan3"])
    return details.select("id", "status", "stage", "error", "segments")


@query("SELECT * FROM (VALUES ('all', 'model', true, true, true, true), ('nothing', 'energy', false, false, false, false), ('no key', 'model', false, true, false, false), ('turns only', 'energy', false, true, false, false), ('silent model', 'energy', false, false, false, false)) t(name, diarize, bank, review, transcribe, correct)")
def readiness(spark, sf):
    """Which steps can run, for several things at hand."""
    some = lambda *_: [{"start": 0}]
    cases = {
        "all": speech.readiness(some, some, True, some, lambda *_: "ok"), "nothing": speech.readiness(), "no key": speech.readiness(some, some, True, embedder_needs_key=True),
        "turns only": speech.readiness(global_turns=True), "silent model": speech.readiness(client=lambda *_: ""),
    }
    return spark.createDataFrame([(n, r.diarize, r.bank, r.review, r.transcribe, r.correct) for n, r in cases.items()], "name string, diarize string, bank boolean, review boolean, transcribe boolean, correct boolean")


@query("SELECT * FROM (VALUES " + ", ".join(f"({quoted(e)}, {quoted(c)}, {quoted(g)})" for e, c, g in U.curated_rules()) + ") t(error, correction, category) UNION ALL SELECT *, 'kept' FROM (VALUES " + ", ".join(f"({quoted(w)}, {quoted(w)})" for w in U.kept_words()) + ") k(error, correction)")
def curated_words(spark, sf):
    return spark.createDataFrame([*U.curated_rules(), *((w, w, "kept") for w in U.kept_words())], "error string, correction string, category string")


@query(f"SELECT doc_id, {glossary_sql('text', [(e, c) for e, c, g in U.curated_rules() if g == 'spellings'])} AS text FROM documents")
def text_spellings(spark, sf):
    """The curated spellings over whole documents."""
    return T.with_glossary(read(spark, sf, "documents").select("doc_id", "text"), "text", [(e, c) for e, c, g in U.curated_rules() if g == "spellings"])


@query("SELECT p_partkey, p_name AS text, CASE WHEN p_partkey % 6 = 5 THEN NULL ELSE 0.9::DOUBLE END AS confidence FROM part")
def json_repair(spark, sf):
    """Answers that are broken in six ways, read after repair."""
    k, name = col("p_partkey") % 6, F.concat(lit('"'), "p_name", lit('"'))
    forms = (
        ('```json\n{"texto_corregido": ', ', "confianza": 0.9}\n```'), ('Here is it: {"texto_corregido": ', ', "confianza": 0.9,} bye'), ('{"texto_corregido": ', ' "confianza": 0.9}'), ('{"texto_corregido": ', '\n"confianza": 0.9 // sure\n}'),
        ('{"confianza": 0.9 /* high */ "texto_corregido": ', "}"), ('{"texto_corregido": ', ', "cambios": ["a", "b"}'),
    )
    answer = F.coalesce(*[F.when(k == n, F.concat(lit(before), name, lit(after))) for n, (before, after) in enumerate(forms)])
    read_ = K.with_repaired_json(read(spark, sf, "part").select("p_partkey", answer.alias("a")), "a")
    return read_.select("p_partkey", F.from_json("a", K.RESPONSE).alias("r")).select("p_partkey", col("r.texto_corregido").alias("text"), col("r.confianza").alias("confidence"))


@query("SELECT p_partkey AS id, upper(p_name) AS batched, upper(p_name) AS single, upper(p_name) AS spread FROM part")
def correction_modes(spark, sf):
    """In batches, one by one, and over other tasks: the same."""
    p = _names(spark, sf)
    as_ = lambda df, name: df.select("id", col("corrected").alias(name))
    return as_(K.corrected(p, _shout), "batched").join(as_(K.corrected(p, _shout, size=1), "single"), "id").join(as_(K.corrected(spread(p, each=3_000), _shout), "spread"), "id")


@query("""WITH r AS (SELECT DISTINCT lower(p_name) AS error FROM part WHERE p_partkey % 3 = 0), f AS (SELECT p_size AS query, p_name AS term, 0 AS source FROM part WHERE p_partkey % 2 = 0 UNION ALL SELECT p_size, p_brand, 1 FROM part),
    n AS (SELECT query, lower(term) AS error, term, source FROM f WHERE lower(term) <> term AND lower(term) NOT IN (FROM r)), o AS (SELECT query, error, arg_min(term, (source, term)) AS correction, min(source) AS source FROM n GROUP BY ALL)
    SELECT query, error, correction, source FROM o QUALIFY source = min(source) OVER (PARTITION BY query)""")
def term_sources(spark, sf):
    """Terms of two sources in order: the second counts where the first adds nothing."""
    p = read(spark, sf, "part")
    rules = p.where("p_partkey % 3 = 0").select(F.lower("p_name").alias("error"), col("p_name").alias("correction"))
    return G.first_source([p.where("p_partkey % 2 = 0").select(col("p_size").alias("query"), col("p_name").alias("term")), p.select(col("p_size").alias("query"), col("p_brand").alias("term"))], rules)


@query("SELECT 'correcciones' AS key, 0 AS pos, 'a' AS error, 'A' AS correction UNION ALL SELECT 'correcciones', 1, 'b', 'otra' UNION ALL SELECT 'correcciones', 2, 'c', 'C' UNION ALL SELECT 'mantener', 0, 'x', NULL UNION ALL SELECT 'mantener', 1, 'y', NULL UNION ALL SELECT 'propio', 0, 'z', NULL")
def glossary_file(spark, sf):
    """A glossary saved, loaded over another one and saved again: repeated errors, lists, keys of its own."""
    path = f"{R.shared_folder(spark)}/glossary-{uuid.uuid4()}.json"
    R.save_glossary(spark, {"correcciones": {"c": "C", "b": "otra"}, "mantener": ["x", "y", "x"], "propio": ["z"]}, path)
    g = R.load_glossary(spark, path, {"correcciones": {"b": "B", "a": "A"}, "mantener": ["x"]})
    R.save_glossary(spark, g, path)
    g = R.load_glossary(spark, path, {})
    rows = [(k, n, e, g[k][e] if isinstance(g[k], dict) else None) for k in g for n, e in enumerate(g[k])]
    return spark.createDataFrame(rows, "key string, pos int, error string, correction string")


@query(f"WITH {REGISTRY} SELECT video_id, CASE WHEN status = 'failed' THEN 'processed' ELSE status END AS status, stage, audio_path FROM registry")
def registry_table(spark, sf):
    """Saved, read, changed, saved over what was read, and read again."""
    path = f"{R.shared_folder(spark)}/registry-{uuid.uuid4()}"
    R.replace(_registry(spark, sf), path)
    R.replace(R.registry(spark, path).withColumn("status", F.when(col("status") == "failed", "processed").otherwise(col("status"))), path)
    return R.registry(spark, path).select("video_id", "status", "stage", "audio_path")


@query(f"WITH {EMB} SELECT vec_id::VARCHAR AS speaker_id, round(list_sum(w), 4) AS total, vec_id AS occurrences FROM u")
def bank_table(spark, sf):
    """Voices saved and read, of length 1."""
    path = f"{R.shared_folder(spark)}/bank-{uuid.uuid4()}"
    R.write_bank(read(spark, sf, "embeddings").select(col("vec_id").cast("string").alias("speaker_id"), "embedding", col("vec_id").cast("int").alias("occurrences"), F.expr(NOW).alias("last_seen")), path)
    return R.bank(spark, path).select("speaker_id", F.round(F.aggregate("embedding", lit(0.0), lambda a, x: a + x), 4).alias("total"), col("occurrences").cast("long").alias("occurrences"))


@query(f"WITH {CACHE} SELECT text_hash, text, (SELECT count(*) FROM cache) AS said FROM cache WHERE created_at >= {NOW} - INTERVAL 30 DAYS")
def cache_table(spark, sf):
    """Entries saved and read: those that haven't expired, and how many the envelope says there are."""
    path = f"{R.shared_folder(spark)}/cache-{uuid.uuid4()}"
    R.write_cache(_cache(spark, sf), path, {"hits": 1})
    said = R.cache_envelope(spark, path)["entries_count"]
    return R.cache(spark, path, F.expr(NOW)).select("text_hash", "text", lit(said).cast("long").alias("said"))


@query(f"WITH {TURNS} SELECT podcast_id, count(*) AS n, count(*) AS consolidated, sum(z - a)::BIGINT AS seconds FROM turns GROUP BY 1")
def metadata_tables(spark, sf):
    """Metadata by recording and of all recordings, and the log of figures, written and read."""
    base = f"{R.shared_folder(spark)}/metadata-{uuid.uuid4()}"
    t = turns(spark, sf).withColumn("seconds", col("end") - col("start"))
    R.write_metadata(t, f"{base}/one")
    R.write_consolidated(t, f"{base}/all")
    R.write_metrics(t.groupBy("podcast_id").agg(F.sum("seconds").alias("seconds")), f"{base}/log")
    n = lambda path, name: spark.read.schema("podcast_id long, turn_idx long").json(f"{base}/{path}").groupBy("podcast_id").agg(F.count("*").alias(name))
    log = spark.read.schema("podcast_id long, seconds long").json(f"{base}/log").select(col("podcast_id").cast("long").alias("podcast_id"), "seconds")
    return n("one", "n").select(col("podcast_id").cast("long").alias("podcast_id"), "n").join(n("all", "consolidated"), "podcast_id").join(log, "podcast_id")


@query("SELECT n_name AS video_id, 'processed' AS status FROM nation")
def resumed_stream(spark, sf):
    """A stream run twice over the same file: each row is processed once."""
    base = f"{R.shared_folder(spark)}/stream-{uuid.uuid4()}"
    for k in range(2):  # with a checkpoint of its own the second run is given all rows again
        rows = spark.readStream.schema("n_nationkey int, n_name string, n_regionkey int").option("pathGlobFilter", "nation.parquet").parquet(sf).select(col("n_name").alias("id"))
        work = lambda df, k=k: df.select(col("id").alias("video_id"), F.lit("processed" if k == 0 else "again").alias("status"), F.current_timestamp().alias("timestamp"))
        N.processed_once(rows, f"{base}/registry", f"{base}/checkpoint-{k}", work, number=k).awaitTermination()
    R.compacted(spark, f"{base}/registry")
    return R.logged(spark, f"{base}/registry").select("video_id", "status")


@query("""WITH r AS (SELECT c_custkey AS k, c_custkey % 12 AS n, c_custkey % 7 = 0 AS blank, CASE c_custkey % 3 WHEN 0 THEN NULL WHEN 1 THEN c_custkey % 12 ELSE 5 END AS ids FROM customer),
    e AS (SELECT k, list_filter([CASE WHEN n < 1 THEN 'texts_present' END, CASE WHEN n > 10 THEN 'at_most_10_texts' END, CASE WHEN blank AND n > 0 THEN 'no_blank_text' END, CASE WHEN ids <> n THEN 'an_id_for_each' END], lambda x: x IS NOT NULL) AS errors FROM r)
    SELECT k AS c_custkey, array_to_string(errors, ',') AS errors, len(errors) = 0 AS is_valid FROM e""")
def request_validation(spark, sf):
    k = col("c_custkey")
    some = lambda n, what: F.when(n > 0, F.transform(F.sequence(lit(1).cast("long"), n), lambda i: what)).otherwise(F.array().cast("array<string>"))
    text = F.when(k % 7 == 0, lit(" ")).otherwise(lit("hola"))
    rows = read(spark, sf, "customer").select("c_custkey", some(k % 12, text).alias("texts"), F.when(k % 3 == 1, some(k % 12, lit("i"))).when(k % 3 == 2, some(lit(5).cast("long"), lit("i"))).alias("ids"))
    return M.validated(rows, M.request_rules()).select("c_custkey", F.array_join("errors", ",").alias("errors"), "is_valid")


@query("""WITH r AS (SELECT c_custkey AS k, (c_custkey % 50 - 1)::BIGINT AS segments, floor(c_acctbal) AS useful, 5000.0::DOUBLE AS total, CASE WHEN c_custkey % 4 = 0 THEN 150.0::DOUBLE ELSE round(floor(c_acctbal) * 100.0::DOUBLE / 5000.0::DOUBLE, 2) END AS efficiency FROM customer),
    e AS (SELECT k, efficiency, list_filter([CASE WHEN segments < 0 THEN 'counts_not_negative' END, CASE WHEN useful < 0 THEN 'times_not_negative' END, CASE WHEN efficiency NOT BETWEEN 0 AND 100 THEN 'efficiency_in_range' END], lambda x: x IS NOT NULL) AS errors FROM r)
    SELECT k AS c_custkey, efficiency, array_to_string(errors, ',') AS errors FROM e""")
def stats_validation(spark, sf):
    k = col("c_custkey")
    rows = read(spark, sf, "customer").select("c_custkey", (k % 50 - 1).alias("segments"), lit(1).alias("speakers"), F.floor("c_acctbal").cast("double").alias("useful"), lit(5000.0).alias("total"), F.when(k % 4 == 0, 150.0).when(k % 4 == 1, 0.0).alias("efficiency"))
    return M.validated(M.with_efficiency(rows), M.stats_rules()).select("c_custkey", "efficiency", F.array_join("errors", ",").alias("errors"))


@query(f"WITH {ANSWERED}, e AS (SELECT p_partkey, list_filter([CASE WHEN length(trim(text)) = 0 THEN 'text_present' END, CASE WHEN changes > 10 THEN 'at_most_10_changes' END, CASE WHEN confidence NOT BETWEEN 0 AND 1 THEN 'confidence_in_range' END], lambda x: x IS NOT NULL) AS errors FROM p) SELECT p_partkey, array_to_string(errors, ',') AS errors FROM e")
def correction_validation(spark, sf):
    rows = _answered(spark, sf).select("p_partkey", col("r.text").alias("corrected"), "r.changes", "r.confidence")
    return M.validated(rows, M.correction_rules()).select("p_partkey", F.array_join("errors", ",").alias("errors"))
