"""Quality rules with the frequency of lines across the documents of a host.

Per document: counts of words, characters, symbols, repeated lines and repeated three-word
windows. Across documents: lines are normalised (blanks collapsed, digits to 0, lower case)
and hashed; a line that more than ``share`` of a host's distinct documents hold, and
``least_docs`` of them at least, is removed. A document left with less than ``left_percent``
of the words of its distinct lines is depleted and rejected.

Documents with the same host and text count as one, so that copies do not make their own
lines frequent. A null text has no words; a null host is a host of its own. Results depend
on a row's host and text only, so repeated rows and ids are no special case. Other columns
are carried along; one with the name of an output column is replaced by the output.

Everything is DataFrame expressions. Hot lines and hot texts are spread by a salt on the
large side of both joins, and counts are combined before each shuffle.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from fleetlens.llm.common import NOT_SPACE, SPACE, words_of, written


@dataclass(frozen=True)
class Limits:
    """``min_words`` and ``repeat_percent`` are the per-document rules."""

    share: float = 0.02
    least_docs: int = 10
    left_percent: int = 30
    min_words: int = 50
    repeat_percent: int = 50
    salts: int = 16


def _with_text_counts(docs: DataFrame, text: str) -> DataFrame:
    body = F.coalesce(F.col(text), F.lit(""))
    first = docs.withColumns(
        {
            "__words": words_of(F.col(text)),
            "__lines": F.filter(F.split(body, "\n"), lambda line: line.rlike(NOT_SPACE)),
            "word_chars": F.length(F.regexp_replace(body, SPACE + "+", "")).cast("long"),
            "n_symbols": F.length(F.regexp_replace(body, r"[^#*$%&|<>]+", "")).cast("long"),
        }
    )
    words = F.col("__words")
    windows = F.when(
        F.size(words) > 2,
        F.transform(
            F.sequence(F.lit(0), F.size(words) - 3),
            lambda i: F.xxhash64(F.get(words, i), F.get(words, i + 1), F.get(words, i + 2)),
        ),
    )
    second = first.withColumns(
        {
            "n_words": F.size(words).cast("long"),
            "n_dup_lines": (F.size("__lines") - F.size(F.array_distinct("__lines"))).cast("long"),
            "__windows": windows,
        }
    ).drop("__words", "__lines")
    # Only texts with a repeated window are sorted: equal hashes then stand side by side.
    hashes = F.col("__windows")
    ordered = F.when(
        F.size(F.array_distinct(hashes)) < F.size(hashes),
        F.sort_array(F.transform(hashes, lambda h, i: F.struct(h.alias("h"), i.alias("at")))),
    )
    third = second.withColumn("__ordered", ordered).drop("__windows")
    pairs = F.col("__ordered")
    twins = F.filter(pairs, lambda p, i: _same(F.get(pairs, i - 1), p) | _same(F.get(pairs, i + 1), p))
    fourth = third.withColumn("__starts", F.sort_array(F.transform(twins, lambda p: p["at"]))).drop("__ordered")
    repeated = F.coalesce(_covered(F.col("__starts")), F.lit(0)).cast("long")
    return fourth.withColumn("n_repeat_words", repeated).drop("__starts")


def _same(other: Column, this: Column) -> Column:
    return F.coalesce(other["h"] == this["h"], F.lit(False))


def _covered(starts: Column) -> Column:
    """Words under three-word windows at these places (ascending)."""
    later = F.concat(F.slice(starts, 2, F.size(starts)), F.array(F.element_at(starts, -1) + 3))
    steps = F.zip_with(later, starts, lambda b, a: F.least(b - a, F.lit(3)))
    return F.aggregate(steps, F.lit(0), lambda total, step: total + step)


def line_hash(line: Column) -> Column:
    """Of a line whose blanks are collapsed already."""
    return F.xxhash64(F.trim(line))


def normal_text(text: Column) -> Column:
    """Blanks within lines collapsed, digits to 0, lower case; line ends stay."""
    blanks = F.regexp_replace(F.coalesce(text, F.lit("")), r"[\x20\x09\x0B-\x0D]+", " ")
    return F.lower(F.regexp_replace(blanks, "[0-9]", "0"))


def _text_key(text: Column) -> Column:
    return F.unhex(F.md5(F.coalesce(text, F.lit("")).cast("binary")))


def _host_key(host: Column) -> Column:
    """Null becomes a host that no other value shares, so that it joins."""
    return F.when(host.isNull(), F.lit("-")).otherwise(F.concat(F.lit("+"), host.cast("string")))


def lines_of(docs: DataFrame, text: str, host: str) -> DataFrame:
    """Distinct lines of the distinct texts of each host: host, text key, line hash, words."""
    normal = docs.select(
        _host_key(F.col(host)).alias("host"),
        _text_key(F.col(text)).alias("text_key"),
        F.split(normal_text(F.col(text)), "\n").alias("lines"),
    )
    line = F.col("line")
    return (
        normal.select("host", "text_key", F.explode("lines").alias("line"))
        .where(F.trim(line) != "")
        .select(
            "host",
            "text_key",
            line_hash(line).alias("line"),
            (F.length(F.trim(line)) - F.length(F.replace(F.trim(line), F.lit(" "), F.lit(""))) + 1).alias("words"),
        )
        .groupBy("host", "text_key", "line")
        .agg(F.max("words").alias("words"))
    )


def frequent_lines(lines: DataFrame, limits: Limits) -> DataFrame:
    """Host and hash of the lines above the limits."""
    per_line = lines.groupBy("host", "line").agg(F.count("*").alias("docs"))
    per_host = lines.select("host", "text_key").distinct().groupBy("host").agg(F.count("*").alias("all_docs"))
    candidates = per_line.where(F.col("docs") >= limits.least_docs)
    return (
        candidates.join(per_host, "host")
        .where(F.col("docs") > F.col("all_docs") * limits.share)
        .select("host", "line")
    )


def _salted(df: DataFrame, salts: int) -> DataFrame:
    return df.withColumn("salt", F.explode(F.sequence(F.lit(0), F.lit(salts - 1))))


def _salt(salts: int, *by: str) -> Column:
    return F.pmod(F.xxhash64(*by), F.lit(salts)).cast("int")


def depletion(docs: DataFrame, limits: Limits, text: str = "text", host: str = "source") -> DataFrame:
    """For texts that hold frequent lines: their hashes, and the percentage of words that is left."""
    lines = written(lines_of(docs, text, host), "lines")
    frequent = _salted(frequent_lines(lines, limits), limits.salts).withColumn("removed", F.lit(True))
    marked = lines.withColumn("salt", _salt(limits.salts, "text_key")).join(frequent, ["host", "line", "salt"], "left")
    return (
        marked.groupBy("host", "text_key")
        .agg(
            F.sum("words").alias("all_words"),
            F.sum(F.when(F.col("removed"), F.lit(0)).otherwise(F.col("words"))).alias("left_words"),
            F.collect_list(F.when(F.col("removed"), F.col("line"))).alias("removed"),
        )
        .where(F.size("removed") > 0)
        .select("host", "text_key", "removed", (100.0 * F.col("left_words") / F.col("all_words")).alias("left"))
    )


def judge(docs: DataFrame, limits: Limits = Limits(), text: str = "text", host: str = "source") -> DataFrame:
    """Add the counts, ``base_failed``, ``removed`` (hashes of removed lines), ``kept``."""
    removed = _salted(depletion(docs, limits, text, host), limits.salts).withColumnsRenamed(
        {"host": "__host", "text_key": "__key", "salt": "__salt", "removed": "__removed", "left": "__left"}
    )
    rows = _with_text_counts(docs, text).withColumns(
        {"__host": _host_key(F.col(host)), "__key": _text_key(F.col(text))}
    )
    rows = rows.withColumn("__salt", F.pmod(F.monotonically_increasing_id(), F.lit(limits.salts)).cast("int"))
    judged = rows.join(removed, ["__host", "__key", "__salt"], "left")
    failed = (F.col("n_words") < limits.min_words) | (
        100 * F.col("n_repeat_words") > limits.repeat_percent * F.col("n_words")
    )
    depleted = F.coalesce(F.col("__left") < limits.left_percent, F.lit(False))
    return (
        judged.withColumn("base_failed", failed)
        .withColumn("kept", ~failed & ~depleted)
        .withColumn("removed", F.coalesce("__removed", F.array().cast("array<bigint>")))
        .drop("__host", "__key", "__salt", "__removed", "__left")
    )


def without_lines(judged: DataFrame, text: str = "text") -> DataFrame:
    """Take the removed lines out of the texts; a text that has none stays as it is."""
    lines = F.split(F.col(text), "\n")
    rest = F.filter(lines, lambda x: ~F.array_contains(F.col("removed"), line_hash(normal_text(x))))
    return judged.withColumn(text, F.when(F.size("removed") > 0, F.array_join(rest, "\n")).otherwise(F.col(text)))
