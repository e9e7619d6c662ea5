"""Terms of any words and letters found by an automaton over whole texts (K3).

The lexicon is stored once; each task reads it and builds one Aho-Corasick automaton of all its
terms, so a text is passed once however many terms there are.  A lexicon beyond ``PART_TERMS``
goes in parts, each with a pass of its own, whose evidence is added up.
"""

from __future__ import annotations

import re

import pyarrow as pa
import pyarrow.dataset as ds
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..session import materialize, ship_package
from ..sources.files import open_location

PART_TERMS = 500_000   # of an automaton
_ASCII_TERM = re.compile("[a-z]+")
_FOUND = "array<struct<t:string,w:double>>"


def normal(text: str) -> str:
    """Lower case, with one space for each run of white space."""
    return " ".join(text.lower().split())


def _is_word(c: str) -> bool:
    return c.isalnum()


def _fits(text: str, start: int, end: int, plain: bool) -> bool:
    """Whether text[start:end] stands alone: a term's letters or digits at its ends meet no other ones.

    For a term of a-z alone, as for tokens, only a-z count as letters.
    """
    if plain:
        return not ("a" <= text[start - 1:start] <= "z" or "a" <= text[end:end + 1] <= "z")
    return not (start and _is_word(text[start]) and _is_word(text[start - 1])
                or end < len(text) and _is_word(text[end - 1]) and _is_word(text[end]))


class Matcher:
    """Occurrences of the terms of a lexicon [(type, term, weight)] in a text, overlapping ones too."""

    def __init__(self, rows: list[tuple[str, str, float]]):
        import ahocorasick

        by_term: dict[str, list[tuple[str, float, str]]] = {}
        for t, term, w in rows:
            if normal(term):
                by_term.setdefault(normal(term), []).append((t, w, term))
        self._automaton = ahocorasick.Automaton()
        for term, uses in by_term.items():
            self._automaton.add_word(term, (len(term), bool(_ASCII_TERM.fullmatch(term)), uses))
        self._any = bool(by_term)
        if self._any:
            self._automaton.make_automaton()

    def evidence(self, text: str | None) -> tuple[dict[str, float], list[str]]:
        """(summed weight by type, distinct terms found)."""
        sums: dict[str, float] = {}
        terms: set[str] = set()
        if text and self._any:
            text = normal(text)
            for last, (n, plain, uses) in self._automaton.iter(text):
                if _fits(text, last + 1 - n, last + 1, plain):
                    for t, w, term in uses:
                        sums[t] = sums.get(t, 0.0) + w
                        terms.add(term)
        return sums, sorted(terms)


def _finder(path: str, part: int):
    def run(batches):
        fs, at = open_location(path)
        table = ds.dataset(at, filesystem=fs, format="parquet").to_table(filter=ds.field("part") == part)
        matcher = Matcher(list(zip(*(table.column(c).to_pylist() for c in ("t", "term", "w")))))
        for batch in batches:
            found = [matcher.evidence(x.as_py()) for x in batch.column(batch.num_columns - 1)]
            sums = [[{"t": t, "w": w} for t, w in s.items()] for s, _ in found]
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), pa.array(sums, pa.list_(pa.struct([("t", pa.string()), ("w", pa.float64())]))),
                 pa.array([x for _, x in found], pa.list_(pa.string()))], ["row", "found", "terms"])
    return run


def term_score(docs: DataFrame, lexicon: DataFrame, id_col: str = "doc_id", text_col: str = "text",
               part_terms: int = PART_TERMS) -> DataFrame:
    """The columns of ``docs`` without the text, and predicted_type, primary_score, evidence, key_terms.

    ``lexicon`` has t (type), term and w (weight, summed by type and term).  Text and terms are
    compared in lower case, white space as single spaces; a term counts wherever it stands
    alone (``_fits``).  One part of the lexicon needs no shuffle; several are summed by row.
    """
    spark = docs.sparkSession
    ship_package(spark)
    n = lexicon.count()
    parts = max(1, -(-n // part_terms))
    place = F.pmod(F.xxhash64("term"), F.lit(parts)).cast("int") if parts > 1 else F.lit(0)
    stored = materialize(lexicon.select("t", "term", "w", place.alias("part")), "lexicon")
    path = stored.inputFiles()[0].rsplit("/", 1)[0]
    kept = [c for c in docs.columns if c != text_col]
    rows = docs.select(F.struct(*kept).alias("row"), F.col(text_col).cast("string").alias("text"))
    struct = rows.schema["row"].dataType.simpleString()
    if parts > 1:  # the same numbers in every pass
        rows = materialize(rows.withColumn("row", F.struct("row", F.monotonically_increasing_id().alias("n"))).select("row", "text"), "texts")
        struct = rows.schema["row"].dataType.simpleString()
    schema = f"row {struct}, found {_FOUND}, terms array<string>"
    passes = [rows.mapInArrow(_finder(path, i), schema) for i in range(parts)]
    got = passes[0]
    if parts > 1:
        for p in passes[1:]:
            got = got.unionAll(p)
        got = got.groupBy("row.n").agg(F.any_value("row.row").alias("row"), F.flatten(F.collect_list("found")).alias("__parts"),
                                       F.array_distinct(F.flatten(F.collect_list("terms"))).alias("terms"))
        types = F.array_distinct(F.transform("__parts", lambda x: x["t"]))
        got = got.withColumn("found", F.transform(types, lambda t: F.struct(t.alias("t"), F.aggregate(
            F.filter("__parts", lambda x: x["t"] == t), F.lit(0.0), lambda a, x: a + x["w"]).alias("w"))))
    total = F.aggregate("found", F.lit(0.0), lambda a, x: a + x["w"])
    best = F.array_max(F.transform(F.filter("found", lambda x: x["w"] > 0), lambda x: F.struct(x["w"].alias("w"), x["t"].alias("t"))))
    scored = got.withColumn("evidence", total).withColumn("__best", best)
    has = F.col("evidence") > 0
    return scored.select(
        *[F.col("row")[c].alias(c) for c in kept],
        F.when(has, F.col("__best.t")).otherwise(F.lit("unknown")).alias("predicted_type"),
        F.when(has, F.col("__best.w") / F.col("evidence")).otherwise(F.lit(0.0)).alias("primary_score"),
        "evidence", F.array_sort("terms").alias("key_terms"))
