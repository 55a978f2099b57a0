"""Correction of texts by a language model: prompts, batches, reading what it answers, gates.

The model is a callable (system, prompt) -> text given by the caller; ``corrected`` runs it in tasks, with retries and errors as rows.
"""

from __future__ import annotations

import json
import re
from collections.abc import Callable, Iterator

import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .metadata import tidy_changes

BATCH, RETRIES, CONFIDENCE = 5, 3, 0.7
RESPONSE = "struct<texto_corregido:string,cambios:array<string>,confianza:double>"
ITEMS = "struct<correcciones:array<struct<id:int,texto_corregido:string,cambios:array<string>,confianza:double>>>"


def glossary_context(rules: DataFrame, keep: DataFrame, most: int = 30) -> DataFrame:
    """(context): the first rules (pos, error, correction) and terms to keep (pos, term), as lines of a prompt."""
    pairs = rules.where(F.col("pos") < most).agg(F.array_join(F.transform(F.array_sort(F.collect_list(F.struct("pos", "error", "correction"))), lambda r: F.concat(F.lit('- "'), r["error"], F.lit('" → "'), r["correction"], F.lit('"'))), "\n").alias("rules"))
    terms = keep.where(F.col("pos") < most).agg(F.array_join(F.transform(F.array_sort(F.collect_list(F.struct("pos", "term"))), lambda r: r["term"]), ", ").alias("terms"))
    return pairs.crossJoin(terms).select(F.concat(F.lit("Correcciones:\n"), "rules", F.lit("\nMantener: "), "terms").alias("context"))


def batched(texts: DataFrame, *order: str, size: int = BATCH) -> DataFrame:
    """texts (group_id, text, ...) with batch and id in it: consecutive groups of ``size`` within each group_id."""
    k = F.row_number().over(Window.partitionBy("group_id").orderBy(*order)) - 1
    return texts.withColumn("__k", k).withColumn("batch", F.floor(F.col("__k") / size)).withColumn("id", F.col("__k") % size).drop("__k")


def prompts(batches: DataFrame) -> DataFrame:
    """(group_id, batch, n, prompt): numbered texts of each batch."""
    listed = F.array_sort(F.collect_list(F.struct("id", "text")))
    lines = F.array_join(F.transform(listed, lambda r: F.concat(r["id"].cast("string"), F.lit('. "'), r["text"], F.lit('"'))), "\n")
    return batches.groupBy("group_id", "batch").agg(F.count("*").alias("n"), lines.alias("lines")).select("group_id", "batch", "n", F.concat(F.lit("Corrige estos textos ("), F.col("n").cast("string"), F.lit("):\n"), "lines").alias("prompt"))


def outer_json(c: Column) -> Column:
    """From the first opening brace to the last closing one."""
    return F.regexp_extract(c, r"(\{[\s\S]*\})", 1)


def parsed(c: Column, original: Column) -> Column:
    """struct(success, text, changes, confidence) of one answer: read as JSON, confidence clamped to [0, 1] (0.5 if missing); else the text alone is saved, at 0.5; else failure with the original."""
    body = outer_json(c)
    got = F.from_json(body, RESPONSE)
    read = got.isNotNull() & (got["texto_corregido"].isNotNull() | got["confianza"].isNotNull() | got["cambios"].isNotNull())
    saved = F.regexp_extract(c, r'"texto_corregido"(?:\s)*[:]\s*"((?:[^"])*)"', 1)
    return F.struct(
        (F.coalesce(read, F.lit(False)) | (saved != "")).alias("success"),
        F.when(read, F.coalesce(got["texto_corregido"], original)).when(saved != "", saved).otherwise(original).alias("text"),
        F.when(read, tidy_changes(F.coalesce(got["cambios"], F.array().cast("array<string>")))).when(saved != "", F.array(F.lit("partial"))).otherwise(F.array().cast("array<string>")).alias("changes"),
        F.when(read, F.greatest(F.lit(0.0), F.least(F.lit(1.0), F.coalesce(got["confianza"], F.lit(0.5))))).when(saved != "", F.lit(0.5)).otherwise(F.lit(0.0)).alias("confidence"),
    )


def matched(batches: DataFrame, answers: DataFrame) -> DataFrame:
    """batches (group_id, batch, id, text) with the answer of their id in answers (group_id, batch, response): the first of several; without one, the original text and error 'missing_in_batch'."""
    items = answers.select("group_id", "batch", F.posexplode_outer(F.from_json(outer_json(F.col("response")), ITEMS)["correcciones"]).alias("pos", "c"))
    first = F.row_number().over(Window.partitionBy("group_id", "batch", "id").orderBy("pos"))
    once = items.where("c is not null").select("group_id", "batch", F.col("c.id").alias("id"), "pos", "c").withColumn("__k", first).where("__k = 1").drop("__k", "pos")
    joined = batches.join(once, ["group_id", "batch", "id"], "left")
    return joined.select(*batches.columns, F.coalesce("c.texto_corregido", "text").alias("corrected"), F.coalesce("c.cambios", F.array().cast("array<string>")).alias("changes"), F.coalesce("c.confianza", F.lit(0.0)).alias("confidence"), F.when(F.col("c").isNull(), "missing_in_batch").alias("error"))


def gated(rows: DataFrame, least: float = CONFIDENCE) -> DataFrame:
    """rows (text, corrected, confidence, error) with the text in force, llm_applied, llm_low_confidence and llm_error: corrections without error and confident enough are applied; recorded as changed only where the text differs."""
    ok = F.col("error").isNull() & (F.col("confidence") >= least)
    return rows.withColumn("final_text", F.when(ok, F.col("corrected")).otherwise(F.col("text"))).withColumn("llm_applied", ok & (F.col("corrected") != F.col("text"))).withColumn("llm_low_confidence", F.col("error").isNull() & (F.col("confidence") < least)).withColumn("llm_error", F.col("error").isNotNull())


def correction_figures(rows: DataFrame) -> DataFrame:
    """(corrected, failed, low_confidence, changes, mean_confidence)."""
    return rows.agg(F.count_if("llm_applied").alias("corrected"), F.count_if("llm_error").alias("failed"), F.count_if("llm_low_confidence").alias("low_confidence"), F.coalesce(F.sum(F.size("changes")), F.lit(0)).alias("changes"), F.round(F.avg(F.when(~F.col("llm_error"), F.col("confidence"))), 6).alias("mean_confidence"))


_REPAIRS = tuple(
    (re.compile(pattern, flags), by)
    for pattern, by, flags in (
        (r"^```(?:json)?\s*|\s*```$", "", 0),  # fences
        (r"^(?:here is.*?:|json:?\s*)", "", re.I),  # what leads in
        (r"(?<!:)//[^\n]*|/\*[\s\S]*?\*/", "", 0),  # comments
        (r",(\s*[}\]])", r"\1", 0),  # commas too many
        (r"\}(\s*)\{", r"},\1{", 0),  # commas too few: between objects,
        (r'"[^\S\n]+"(?=[^":,{}\[\]]*":)', '", "', 0),  # between a value and a name,
        (r'([\d"\]])(\s*\n\s*|\s+)(?=")', r"\1,\2", 0),  # and after a value, over lines too
        (r'\b(true|false|null)(\s+)(?=")', r"\1,\2", 0),
    )
)


def repaired_json(s: str) -> str:
    """An answer made parseable: outer braces, fences and comments off, commas put or taken, odd quotes closed, brackets closed, nothing after the last brace. What parses stays as it is."""
    s = s.strip()
    if m := re.search(r"\{[\s\S]*\}", s):
        s = m[0]
    try:
        json.loads(s)
        return s
    except ValueError:
        pass
    for pattern, by in _REPAIRS:
        s = pattern.sub(by, s)
    lines = [line.rstrip() + '"' if line.count('"') % 2 and not line.rstrip().endswith('"') else line for line in s.split("\n")]
    s = "\n".join(lines)
    s = s[: s.rfind("}") + 1] or s
    missing = s.count("[") - s.count("]")
    if missing > 0 and s.endswith("}"):
        s = s[:-1] + "]" * missing + "}"
    return s


def with_repaired_json(df: DataFrame, column: str) -> DataFrame:
    """``column`` made parseable, in Arrow batches; null stays null."""

    @F.pandas_udf("string")
    def of(texts: pd.Series) -> pd.Series:
        return texts.map(lambda t: None if t is None else repaired_json(t))

    return df.withColumn(column, of(F.col(column)))


Client = Callable[[str, str], str]


def healthy(client: Client, tries: int = 1) -> bool:
    """Whether the model answers anything."""
    for _ in range(tries):
        try:
            if str(client("", "ping") or "").strip():
                return True
        except Exception:  # noqa: BLE001, S112 - a model that fails isn't healthy
            continue
    return False


def read_batch(answer: str, texts: list[str]) -> list[tuple[str, list[str], float, str | None]] | None:
    """(text, changes, confidence, error) of each text of a batch, or None if nothing can be read."""
    for s in (answer, repaired_json(answer)):
        try:
            items = json.loads(s if s.lstrip().startswith("{") else (re.search(r"\{[\s\S]*\}", s) or [""])[0])["correcciones"]
            break
        except (ValueError, KeyError, TypeError):
            continue
    else:
        return None
    by: dict[int, dict] = {}
    for x in items if isinstance(items, list) else []:
        if isinstance(x, dict) and isinstance(x.get("id"), int):
            by.setdefault(x["id"], x)
    out = []
    for k, t in enumerate(texts):
        x = by.get(k)
        if x is None or not str(x.get("texto_corregido") or "").strip():
            out.append((t, [], 0.0, "missing_in_batch"))
        else:
            changes = [c.strip() for c in x.get("cambios") or [] if isinstance(c, str) and c.strip()]
            try:
                confidence = min(1.0, max(0.0, float(x.get("confianza", 0.5))))
            except (TypeError, ValueError):
                confidence = 0.5
            out.append((x["texto_corregido"].strip(), changes, round(confidence, 2), None))
    return out


def corrected(texts: DataFrame, client: Client, system: str = "", size: int = BATCH, retries: int = RETRIES, repairs: int = 2) -> DataFrame:
    """(id, corrected, changes, confidence, error) of texts (id, text). Batches of ``size`` per call; an answer that can't be read is asked for again as JSON ``repairs`` times, a call is tried ``retries`` times, and then each text by itself. Blank texts aren't sent. No failure fails a task."""

    def ask(batch: list[str]) -> list[tuple[str, list[str], float, str | None]] | None:
        prompt = "\n".join(f'{k}. "{t}"' for k, t in enumerate(batch))
        for _ in range(retries):
            try:
                answer = client(system, prompt)
                for again in range(repairs + 1):
                    if (got := read_batch(answer, batch)) is not None:
                        return got
                    if again < repairs:
                        answer = client(system, f"JSON:\n{answer}")
            except Exception:  # noqa: BLE001 - the model's errors are counted as tries
                continue
        return None

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf in batches:
            rows = []
            sent = [(i, t) for i, t in zip(pdf["id"], pdf["text"]) if t and t.strip()]
            rows += [(i, t, [], 0.0, "empty") for i, t in zip(pdf["id"], pdf["text"]) if not (t and t.strip())]
            for at in range(0, len(sent), size):
                part = sent[at : at + size]
                got = ask([t for _, t in part])
                if got is None:
                    got = [(ask([t]) or [(t, [], 0.0, "failed")])[0] for _, t in part]
                rows += [(i, *g) for (i, _), g in zip(part, got)]
            yield pd.DataFrame(rows, columns=["id", "corrected", "changes", "confidence", "error"])

    return texts.select("id", "text").mapInPandas(run, "id long, corrected string, changes array<string>, confidence double, error string")
