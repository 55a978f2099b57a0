"""Queries over all rows of their tables, against plain Python on small tables."""

import hashlib
import math
import re

from voxweave import queries as Q
from voxweave.operators import glossary as G


def test_text_capitals_of_all_languages(spark, tmp_path):
    texts = ["hallo welt. ¿wie geht es? ja", "ärger. über! öl", "ßa. b", None, "", "x.  y"]
    rows = [(k, t, g) for k, (t, g) in enumerate((t, g) for t in texts for g in ("de", "es", None))]
    spark.createDataFrame(rows, "doc_id long, text string, lang string").write.parquet(f"{tmp_path}/documents.parquet")
    plain = lambda t: t and re.sub(r"([.!?¿¡]\s+)([a-záéíóúñ])", lambda m: m[1] + m[2].upper(), t[:1].upper() + t[1:])
    got = {r["doc_id"]: r["text"] for r in Q.text_capitals(spark, str(tmp_path)).collect()}
    assert got == {k: plain(t) for k, t, _ in rows}


def test_page_terms_with_accents(spark, tmp_path):
    pages = [(1, "<b>Élan Vital</b> y Madrid <a href='/x'>Über uns</a>"), (2, "<b>Ñandú</b>"), (3, '<h2 class="result__title" id=a>Größe  Zwei</h2> The Home'), (4, "nada"), (5, None), (5, "<b>x</b><b>Ab</b><b>Abc</b> Abc")]
    spark.createDataFrame(pages, "page_id long, html string").write.parquet(f"{tmp_path}/pages.parquet")
    want = set()
    for k, html in pages:
        for p in G.TERM_PATTERNS:
            for t in re.findall(p, html or ""):
                t = re.sub(r"\s+", " ", re.sub(r"<[^>]+>", "", t)).strip()
                if 3 <= len(t) <= 50 and t.lower() not in G.COMMON and any(c.isupper() for c in t):
                    want.add((k, t))
    got = [tuple(r) for r in Q.page_terms(spark, str(tmp_path)).select("page_id", "term").collect()]
    assert sorted(got) == sorted(want)
    assert {(1, "Élan Vital"), (1, "Über uns"), (2, "Ñandú"), (3, "Größe Zwei")} <= want


def test_no_row_of_orders_is_left_out(spark, tmp_path):
    keys = list(range(1, 131))
    spark.createDataFrame([(k,) for k in keys], "o_orderkey long").selectExpr("o_orderkey", "date'1995-01-01' AS o_orderdate").write.parquet(f"{tmp_path}/orders.parquet")
    assert tuple(Q.shown_errors(spark, str(tmp_path)).select("shown", "more").first()) == ("|".join(f"error {k}" for k in keys[:5]), 125)
    status, stage = ("processed", "failed", "skipped"), ("downloaded", "processing", "download", "completed")
    done = lambda k: k % 3 == 1 and k % 10 not in (1, 3)
    got = sorted(tuple(r) for r in Q.registry_upsert(spark, str(tmp_path)).select("video_id", "status", "stage").collect())
    assert got == sorted((f"v{k}", "processed" if done(k) else status[k % 3], "completed" if done(k) else stage[k % 4]) for k in keys)
    got = sorted(r["video_id"] for r in Q.retry_selection(spark, str(tmp_path)).collect())
    assert got == sorted(f"v{k}" for k in keys if k % 4 == 0 and k % 3 in (0, 1))


def test_all_parts_make_rules(spark, tmp_path):
    parts = [(k, f"name {k % 7}", f"brand {k}", f"type {k}") for k in range(1, 12)]
    spark.createDataFrame(parts, "p_partkey long, p_name string, p_brand string, p_type string").write.parquet(f"{tmp_path}/part.parquet")
    rules: dict = {}
    for k, name, brand, kind in sorted(parts, key=lambda p: (p[0] % 3 != 0, p[0])):
        rules[name] = brand if k % 3 == 0 else kind
    assert [tuple(r) for r in Q.glossary_merge(spark, str(tmp_path)).orderBy("pos").collect()] == [(i, e, c) for i, (e, c) in enumerate(rules.items())]
    base = {p[1] for p in parts if p[0] % 3 == 0}
    assert {r["category"]: r["rules"] for r in Q.glossary_growth(spark, str(tmp_path)).collect()} == {"base": len(base), "new": len(rules) - len(base)}


def test_every_text_has_a_cache_entry(spark, tmp_path):
    texts = {k: f"Texto {k}" for k in range(1, 41)} | {50: "texto 2", 51: "texto 2"}
    spark.createDataFrame(list(texts.items()), "doc_id long, text string").write.parquet(f"{tmp_path}/documents.parquet")
    h = lambda t: hashlib.md5(t.strip().lower().encode()).hexdigest()
    key = lambda k: h(texts[k] if k % 2 == 0 else texts[k] + " antes")
    first: dict = {}
    for k in sorted(texts):
        first.setdefault(key(k), k)
    assert {tuple(r) for r in Q.cache_expiry(spark, str(tmp_path)).select("text_hash", "text").collect()} == {(x, f"c{k}") for x, k in first.items() if k % 60 <= 30}
    n = {x: sum(h(t) == x for t in texts.values()) for x in first}
    assert {tuple(r) for r in Q.cache_hits(spark, str(tmp_path)).select("text_hash", "hits", "accessed").collect()} == {(x, k % 5 + n[x], n[x] > 0) for x, k in first.items()}


def test_all_embeddings_in_bank_and_queries(spark, tmp_path):
    rows = [(k, k % 3, [math.cos(k * 0.7), math.sin(k * 0.7), 0.2 * (k % 4)]) for k in range(12)]
    spark.createDataFrame(rows, "vec_id long, label long, embedding array<double>").write.parquet(f"{tmp_path}/embeddings.parquet")
    unit = lambda v: [x / math.sqrt(sum(y * y for y in v)) for x in v]
    bank = {g: unit([sum(x) / 4 for x in zip(*(unit(v) for _, label, v in rows if label == g))]) for g in range(3)}
    got = {r["label"]: (r["total"], r["first"]) for r in Q.mean_embeddings(spark, str(tmp_path)).collect()}
    assert got == {g: (round(sum(b), 6), round(b[0], 6)) for g, b in bank.items()}
    near = {r["query_id"]: (r["speaker_id"], r["score"]) for r in Q.nearest_speakers(spark, str(tmp_path)).collect()}
    want = {k: max((sum(a * b for a, b in zip(unit(v), bank[g])), g) for g in range(3)) for k, _, v in rows}
    assert near == {k: (str(g) if c >= 0.5 else None, round(c, 6)) for k, (c, g) in want.items()}
