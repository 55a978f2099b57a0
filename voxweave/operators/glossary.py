"""Glossaries: rules (pos, error, correction) and terms to keep (pos, term); merging, growing, terms from pages."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions.text import strip, unaccented
from .curated import kept_words

COMMON = "about all and are but can code como con contact ddg del doctype esta este esto for get had has help her home html las lite los more next not one our out page para pero por previous privacy puede que results search son terms the this transitional una utf was you".split()
TITLE_SKIPS = ("anexo:", "archivo:", "categoría:", "desambiguación", "plantilla:", "wikipedia:")
TERM_PATTERNS = (r"\b([A-Z][A-Za-z][A-Za-z]+(?:\s\s*[A-Z][A-Za-z]+)?)\b", r"<b>((?:[^<])+)</b>", r"<[a][^>]*>((?:[^<])+)</a>", r'class="result__(?:title|snippet)"[^>]*>((?:[^<])+)<')

#: Default rules: what is written as it stands, and pairs.
_CAPITALS = "b2b b2c api kpi roi sem seo url gpt".split()
_NAMES = "Amazon Apple ChatGPT Claude Facebook Gemini Google Instagram Meta Microsoft Netflix OpenAI Spotify TikTok Twitter WhatsApp YouTube".split()
_PAIRS = "gemina=Gemini|ia=IA|ai=IA|i.a.=IA|a.i.=IA|atravez=a través|atraves=a través|talvez=tal vez|osea=o sea|enserio=en serio|aveces=a veces|almenos=al menos|esque=es que|deveras=de veras|nadien=nadie|haiga=haya|nose=no sé|hicistes=hiciste|dijistes=dijiste|aparte=aparte"
_QUESTIONS = "que es=qué es|como es=cómo es|por que=por qué|porque =por qué |quien =quién |cual =cuál |donde =dónde |cuando =cuándo "


def default_rules() -> list[tuple[str, str]]:
    """(error, correction), in order: question words, names, capitals, spellings."""
    split = lambda s: [tuple(p.split("=")) for p in s.split("|")]
    return [*split(_QUESTIONS), *((n.lower(), n) for n in _NAMES), *((c, c.upper()) for c in _CAPITALS), *split(_PAIRS)]


def default_glossary() -> dict:
    """The built-in glossary as a file holds it: rules, words to keep, words to leave out."""
    return {"correcciones": dict(default_rules()), "mantener": kept_words(), "eliminar": []}


def merged_keys(base: dict, custom: dict) -> dict:
    """A glossary's keys, open to new ones: rules of both, of which a repeated error keeps its place and takes the custom correction; lists one after the other; any other key as custom has it."""
    out = {k: dict(v) if isinstance(v, dict) else list(v) if isinstance(v, list) else v for k, v in base.items()}
    for k, v in custom.items():
        if isinstance(out.get(k), dict) and isinstance(v, dict):
            out[k].update(v)
        elif isinstance(out.get(k), list) and isinstance(v, list):
            out[k].extend(v)
        elif k not in out:
            out[k] = v
    return out


def first_source(sources: list[DataFrame], rules: DataFrame) -> DataFrame:
    """(query, error, correction, source) of terms (query, term) found by several sources in order: for each query, what the first of them that adds any rule adds. A later one counts only where those before it add nothing."""
    found = None
    for k, s in enumerate(sources):
        one = s.select(F.col("query"), F.col("term"), F.lit(k).alias("source"))
        found = one if found is None else found.unionByName(one)
    low, plain = F.lower("term"), unaccented(F.lower("term"))
    forms = F.array_compact(F.array(F.when(low != F.col("term"), low), F.when(plain != low, plain)))
    new = found.select("query", "source", F.explode(forms).alias("error"), F.col("term").alias("correction")).join(rules.select("error"), "error", "left_anti")
    first = new.groupBy("query", "error").agg(F.min_by("correction", F.struct("source", "correction")).alias("correction"), F.min("source").alias("source"))
    least = first.groupBy("query").agg(F.min("source").alias("source"))
    return first.join(least, ["query", "source"]).select("query", "error", "correction", "source")


#: Rows of a run of positions that are numbered together.
_RUN = 4096


def _placed(rows: DataFrame) -> DataFrame:
    """rows (part, pos, ...) with pos counted from 0 over both in order: runs of positions are counted, their starts summed up, and rows numbered within their run, so no task holds them all."""
    run = rows.withColumn("__run", F.floor(F.col("pos") / _RUN))
    starts = run.groupBy("part", "__run").agg(F.count("*").alias("__n"))
    before = F.coalesce(F.sum("__n").over(Window.orderBy("part", "__run").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))  # a row for each run
    within = F.row_number().over(Window.partitionBy("part", "__run").orderBy("pos")) - 1
    return run.join(starts.select("part", "__run", before.alias("__before")), ["part", "__run"]).withColumn("pos", F.col("__before") + within)


def merged(base: DataFrame, custom: DataFrame) -> DataFrame:
    """Rules of both: a repeated error keeps its first place and takes its last correction; new ones follow."""
    both = base.select(F.lit(0).alias("part"), "pos", "error", "correction").unionByName(custom.select(F.lit(1).alias("part"), "pos", "error", "correction"))
    once = both.groupBy("error").agg(F.min(F.struct("part", "pos")).alias("first"), F.max_by("correction", F.struct("part", "pos")).alias("correction"))
    return _placed(once.select("first.part", "first.pos", "error", "correction")).select("pos", "error", "correction")


def kept_terms(base: DataFrame, custom: DataFrame, distinct: bool = False) -> DataFrame:
    """Terms of both in order: with repeats as they are loaded, or once each as they are saved."""
    both = base.select(F.lit(0).alias("part"), "pos", "term").unionByName(custom.select(F.lit(1).alias("part"), "pos", "term"))
    if distinct:
        both = both.groupBy("term").agg(F.min(F.struct("part", "pos")).alias("f")).select("f.part", "f.pos", "term")
    return _placed(both).select("pos", "term")


def added(rules: DataFrame, new: DataFrame) -> DataFrame:
    """rules (error, correction, category) and the new ones whose error is absent and differs from its correction in more than case; the first of several."""
    fresh = new.where(F.lower("error") != F.lower("correction")).join(rules.select("error"), "error", "left_anti")
    rank = F.row_number().over(Window.partitionBy("error").orderBy("pos"))
    return rules.unionByName(fresh.withColumn("__k", rank).where("__k = 1").select(*rules.columns))


def sorted_rules(rules: DataFrame) -> DataFrame:
    return rules.orderBy("error")


def growth(rules: DataFrame) -> DataFrame:
    """(category, rules)."""
    return rules.groupBy("category").agg(F.count("*").alias("rules"))


def valid_term(t: Column) -> Column:
    """3 to 50 characters, not a common word, with a capital."""
    return F.length(t).between(3, 50) & ~F.lower(t).isin(COMMON) & t.rlike(r"\p{Lu}")


def valid_title(t: Column) -> Column:
    """3 to 60 characters, not of a special page."""
    return F.length(t).between(3, 60) & ~F.lower(t).rlike("|".join(TITLE_SKIPS))


def page_terms(pages: DataFrame) -> DataFrame:
    """(page_id, term): distinct valid terms of each page: capitalised words, bold text, links, result titles."""
    found = F.flatten(F.array(*[F.regexp_extract_all("html", F.lit(p), F.lit(1)) for p in TERM_PATTERNS]))
    terms = pages.select("page_id", F.explode(found).alias("term"))
    tidy = strip(F.regexp_replace(F.regexp_replace("term", "<[^>]+>", ""), r"\s+", " "))
    return terms.select("page_id", tidy.alias("term")).where(valid_term(F.col("term"))).distinct()


def variants(terms: DataFrame) -> DataFrame:
    """(error, correction): the lower-case form of each term, and its unaccented form, where they differ from it."""
    low = terms.select(F.lower("term").alias("error"), F.col("term").alias("correction"))
    plain = terms.select(unaccented(F.col("term")).alias("error"), F.col("term").alias("correction"))
    return low.unionByName(plain).where("error <> correction").distinct()
