"""Files of questions: ratios of signals, scores, tiers; and domains by file rules and content."""

from __future__ import annotations

import json

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from ..functions import tables as T
from ..functions.phrases import Phrases
from ..functions.text import any_of
from ..sources.scratch import written


#: What every match of a pattern holds, in lower case; of the others only a search can tell.
_HELD = {
    "choices?": ["choice"], "options?": ["option"], "(A)": ["(a)", "(b)", "(c)", "(d)"], "请选择": ["请选择"], "选项": ["选项"], "main subject": ["s the main subject"],
    "describe": ["describe the image", "describe this image"], "caption": ["caption"], "you see": ["what do you see"], "chart": ["summarize the chart"],
    "quality": ["compare the quality"], "all text": ["please extract all text"],
}


def _held(pattern: str) -> list[str]:
    return next((v for k, v in _HELD.items() if k in pattern.replace("\\", "")), [])


def matches_any(x: Column, patterns: list[str], phrases: Phrases | None = None, found: Column | None = None) -> Column:
    """Any of the patterns, without regard to case. Patterns whose matches hold one of some phrases are searched for only where such a phrase is found."""
    search = lambda ps: x.rlike(f"(?i)(?:{'|'.join(ps)})") if ps else F.lit(False)
    if phrases is None:
        return search(patterns)
    gated = [p for p in patterns if _held(p)]
    return phrases.any(found, [h for p in gated for h in _held(p)]) & search(gated) | search([p for p in patterns if not _held(p)])


def keyword_bank(text: str) -> dict[str, list[str]]:
    """The lists of a JSON document of keywords, in lower case with spaces for underscores, sorted and without repeats."""
    raw = json.loads(text)
    return {k: sorted({str(x).lower().replace("_", " ").strip() for x in v} - {""}) for k, v in raw.items() if isinstance(v, list)}


def _topics(bank: dict[str, list[str]] | None) -> tuple[list[str], list[str]]:
    bank = bank or {}
    return [x for k in ("subjects", "subfields", "visual_cues") for x in bank.get(k, [])], bank.get("question_cues", [])


def known_phrases(bank: dict[str, list[str]] | None = None) -> Phrases:
    """All that signals look for in the lower-cased question."""
    return Phrases([*T.REASONING_STYLE, *T.MATH, *T.SCIENCE, *T.ENGINEERING, *T.HUMANITIES, *(x for xs in _topics(bank) for x in xs), *(h for hs in _HELD.values() for h in hs)])


def signals(question: Column, found: Column, bank: dict[str, list[str]] | None = None) -> dict[str, Column]:
    """What a question shows; found: its known phrases. Fields other than mathematics count only in questions of an examination style."""
    known = known_phrases(bank)
    has = lambda phrases: known.any(found, phrases)
    choice, (topic, cues) = matches_any(question, T.CHOICE_PATTERNS, known, found), _topics(bank)
    style = choice | has(T.REASONING_STYLE)
    return {
        "mcq": choice,
        "math": has(T.MATH),
        "sci": style & has(T.SCIENCE),
        "eng": style & has(T.ENGINEERING),
        "hum": style & has(T.HUMANITIES),
        "low_caption": matches_any(question, T.CAPTION_PATTERNS, known, found),
        "topic": has(topic) & (style | has(cues)),
    }


def file_ratios(questions: DataFrame, file: str, question: str, bank: dict[str, list[str]] | None = None) -> DataFrame:
    """Shares of the signals and the mean length of the questions of each file."""
    rows = questions.select(file, question, known_phrases(bank).found(F.lower(question)).alias("__found"))
    made = signals(F.col(question), F.col("__found"), bank)
    shares = [F.avg(c.cast("double")).alias(f"{k}_ratio") for k, c in made.items()]
    return rows.groupBy(file).agg(F.count("*").alias("sample_n"), *shares, F.avg(F.length(question)).alias("avg_q_len"))


def file_scores(ratios: DataFrame, math_weight: float = 0.55) -> DataFrame:
    r = lambda k: F.col(f"{k}_ratio")
    clean = 1 - F.least(r("low_caption"), F.lit(0.5))
    rows = ratios.withColumn("score_math", 0.55 * r("math") + 0.30 * r("mcq") + 0.15 * clean)
    rows = rows.withColumn("score_mmmu", 0.30 * (r("sci") + r("eng") + r("hum")) + 0.25 * r("mcq") + 0.30 * r("topic") + 0.15 * clean)
    return rows.withColumn("combined_score", math_weight * F.col("score_math") + (1 - math_weight) * F.col("score_mmmu"))


def _numbered(rows: DataFrame, name: str, order: list[Column], *keys: str) -> DataFrame:
    """rows with their number from 1 in the order, within the keys.

    Rows are dealt to ranges of keys and order, and the number of rows of the same keys in the ranges before it is added to a row's place in its range, so that no task ranks all."""
    dealt = written(rows.repartitionByRange(*keys, *order).withColumn("__range", F.spark_partition_id()), "ranges")
    same = [F.struct(*keys).alias("__key")] if keys else []
    sizes = dealt.groupBy("__range", *same).agg(F.count("*").alias("__size"))
    ahead = F.coalesce(F.sum("__size").over(W.partitionBy(*["__key"] * bool(keys)).orderBy("__range").rowsBetween(W.unboundedPreceding, -1)), F.lit(0))
    ahead = F.broadcast(sizes.withColumn("__ahead", ahead).drop("__size"))
    placed = dealt.select("*", *same).withColumn("__place", F.row_number().over(W.partitionBy("__range", *keys).orderBy(*order)))
    placed = placed.join(ahead, ["__range", *["__key"] * bool(keys)])
    return placed.withColumn(name, F.col("__ahead") + F.col("__place")).select(*rows.columns, name)


def tiers(scores: DataFrame, first: int, second: int, *ties: str) -> DataFrame:
    """Every file with its rank: the best are P0, the next P1, all others excluded. ties settle the order."""
    ranked = _numbered(scores, "rank", [F.desc("combined_score"), *[F.asc_nulls_last(t) for t in ties]]).withColumn("rank", F.col("rank").cast("int"))
    return ranked.withColumn("tier", F.when(F.col("rank") <= first, "P0").when(F.col("rank") <= first + second, "P1").otherwise("excluded"))


def head(df: DataFrame, n: int, file: str, *order: str) -> DataFrame:
    """The first n rows of each file."""
    return df.withColumn("__n", F.row_number().over(W.partitionBy(file).orderBy(*order))).where(F.col("__n") <= n).drop("__n")


def _hinted(held: dict[str, Column], hints: dict[str, list[str]]) -> Column:
    found = [F.when(held[k], F.array(*map(F.lit, d))).otherwise(F.array().cast("array<string>")) for k, d in hints.items()]
    return F.array_sort(F.array_distinct(F.flatten(F.array(*found)))) if found else F.array().cast("array<string>")


def content_domains(content: Column, hints: dict[str, list[str]]) -> Column:
    """Domains of the keywords that the content holds, sorted."""
    low = F.lower(content)
    return _hinted({k: low.contains(k.lower()) for k in hints}, hints)


def domains_of_all(text: Column, hints: dict[str, list[str]]) -> Column:
    """An aggregate: domains of the keywords that any text of a group holds, sorted. Texts are not joined, so a group may be of any size; a keyword lies within one text."""
    low = F.lower(text)
    return _hinted({k: F.bool_or(low.contains(k.lower())) for k in hints}, hints)


def file_domains(file: Column, content: Column, exact: dict[str, list[str]], hints: dict[str, list[str]], prefixes: list[str]) -> Column:
    """Domains by the file's name, else `general`; those of general files with one of the prefixes grow by their content."""
    return grown_domains(file, content_domains(F.coalesce(content, F.lit("")), hints), exact, prefixes)


def grown_domains(file: Column, found: Column, exact: dict[str, list[str]], prefixes: list[str]) -> Column:
    """The same of domains that were found in the content."""
    named = F.lit(None).cast("array<string>")
    for name, domains in exact.items():
        named = F.when(file == name, F.array(*map(F.lit, domains))).otherwise(named)
    own = F.coalesce(named, F.array(F.lit("general")))
    sampled = any_of(file.startswith(p) for p in prefixes) & F.array_contains(own, "general")
    return F.when(sampled, F.array_sort(F.array_union(own, found))).otherwise(own)


def related(domains: Column, wanted: list[str]) -> Column:
    return F.arrays_overlap(F.transform(domains, F.lower), F.array(*map(F.lit, wanted)))


def inverted(manifest: DataFrame, file: str = "file", domains: str = "domains") -> DataFrame:
    """(domain, files): the sorted different files of each domain, a row for each domain."""
    return manifest.select(F.explode(domains).alias("domain"), file).groupBy("domain").agg(F.array_sort(F.collect_set(file)).alias("files"))


def inverted_rows(manifest: DataFrame, file: str = "file", domains: str = "domains") -> DataFrame:
    """(domain, file, place): the same lists as rows, so that a domain may have any number of files; a file without a name comes last."""
    pairs = manifest.select(F.explode(domains).alias("domain"), file).distinct()
    return _numbered(pairs, "place", [F.asc_nulls_last(file)], "domain")
