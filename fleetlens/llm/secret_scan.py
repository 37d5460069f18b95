"""Secrets in texts: fixed patterns, and a character Markov model for other random strings.

Patterns give the spans of the kinds ``assign``, ``access`` and ``hex``. Runs of
``candidate_chars`` or more characters of an alphabet of 66 are scored as well: two
first-order Markov models, one of random strings and one of ordinary identifiers, give a
log-likelihood ratio; a run above the limits is a span of the kind ``random``. What spans of
patterns cover is cut out of a run, and what is left on either side is a run of its own. In
a run that is not above the limits as a whole (a path, a key joined to words) the stretches
of the largest ratio are looked for, first from separator to separator, then the parts
between separators, then from any character to any; those above the limits are spans. The models are trained from labelled strings, with a pseudo
count for every pair of characters, so they work even without samples.

Places are code points, ends are exclusive. A null or empty text has no spans. Rows are
independent; all input columns stay, one with the name of an output column is replaced.
Everything is DataFrame expressions; the model is a constant array of at most 66 x 66.
"""

from __future__ import annotations

import json
import math
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from fleetlens.llm.common import sampled_texts

ALPHABET = "ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789+/_-"

ASSIGN = r"""(?i:password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)"""
# The runs are maximal, so asking for the least length in the pattern drops the same matches.
ACCESS = r"AKIA[A-Z0-9]{12,}"
HEX = r"[0-9a-f]{32,}"

KINDS = ("assign", "access", "hex", "random")


@dataclass(frozen=True)
class Settings:
    """A candidate is random where the ratio is above both limits (in nats)."""

    candidate_chars: int = 20
    per_char: float = 0.5
    in_all: float = 15.0
    pseudo: float = 0.5
    # Different texts, at most so many, whose words are samples of ordinary identifiers.
    sample_docs: int = 1_000

    @property
    def candidates(self) -> str:
        return rf"[A-Za-z0-9+/_-]{{{self.candidate_chars},}}"


def pairs(text: Column) -> Column:
    """Places in the pair table of the neighbouring characters of a string; null outside the alphabet."""
    n = len(ALPHABET)
    places = F.transform(
        F.sequence(F.lit(1), F.greatest(F.length(text), F.lit(1))),
        lambda i: F.instr(F.lit(ALPHABET), F.substring(text, i, F.lit(1))) - 1,
    )
    return F.filter(
        F.zip_with(places, F.slice(places, 2, F.size(places)), lambda a, b: F.when((a >= 0) & (b >= 0), a * n + b)),
        lambda p: p.isNotNull(),
    )


def labelled_samples(docs: DataFrame, settings: Settings, text: str = "text") -> DataFrame:
    """Rows (string, random) made from documents.

    Random: what the patterns find in any document, and for every ordinary sample its MD5
    written in hex and in base64. Ordinary: the words of eight or more characters of a
    hash sample of different texts.
    """
    body = F.coalesce(F.col(text), F.lit(""))
    found = docs.select(
        F.explode(
            F.concat(
                F.when(body.rlike(ASSIGN), F.regexp_extract_all(body, F.lit(ASSIGN), 1)).otherwise(F.array()),
                F.when(body.rlike(ACCESS), F.regexp_extract_all(body, F.lit(ACCESS), 0)).otherwise(F.array()),
                F.when(body.rlike(HEX), F.regexp_extract_all(body, F.lit(HEX), 0)).otherwise(F.array()),
            )
        ).alias("string")
    )
    sampled = sampled_texts(docs.select(F.lit(0).alias("all"), F.col(text)), settings.sample_docs, "all", text)
    ordinary = (
        sampled
        .select(F.explode(F.regexp_extract_all(body, F.lit(r"[A-Za-z][A-Za-z0-9_-]{7,}"), 0)).alias("string"))
        .where(~F.col("string").rlike(ACCESS) & ~F.col("string").rlike(HEX) & ~F.col("string").rlike("[0-9].*[0-9]"))
    )
    made = ordinary.select(F.explode(F.array(F.md5("string"), F.base64(F.unhex(F.md5("string"))))).alias("string"))
    return (
        found.where(F.length("string") >= 8)
        .unionByName(made)
        .select("string", F.lit(True).alias("random"))
        .unionByName(ordinary.select("string", F.lit(False).alias("random")))
    )


def train(samples: DataFrame, settings: Settings = Settings()) -> list[float]:
    """Log-likelihood ratios (random against ordinary) by place in the pair table."""
    n = len(ALPHABET)
    counts = (
        samples.select(F.explode(pairs(F.col("string"))).alias("pair"), "random")
        .groupBy("pair")
        .agg(F.count_if("random").alias("yes"), F.count_if(~F.col("random")).alias("no"))
    )
    a = settings.pseudo
    yes, no = [a] * (n * n), [a] * (n * n)
    for row in counts.collect():  # at most 66 x 66 rows
        yes[row.pair] += row.yes
        no[row.pair] += row.no
    ratios = []
    for first in range(n):
        row = slice(first * n, first * n + n)
        of_yes, of_no = sum(yes[row]), sum(no[row])
        ratios += [math.log(y / of_yes) - math.log(x / of_no) for y, x in zip(yes[row], no[row])]
    return ratios


def places(text: Column, pattern: str, kind: int, group: int = 0, least: int = 1) -> Column:
    """Spans of the leftmost non-overlapping matches whose group has ``least`` characters.

    The texts between matches and the matches themselves give the places: their lengths add up.
    """
    gaps = F.split(text, pattern, -1)
    found = F.regexp_extract_all(text, F.lit(pattern), 0)
    value = F.regexp_extract_all(text, F.lit(pattern), group) if group else found
    parts = F.arrays_zip(
        F.transform(F.slice(gaps, 1, F.size(found)), F.length).alias("gap"),
        F.transform(found, F.length).alias("long"),
        value.alias("value"),
    )
    empty = F.array().cast("array<struct<start:int,kind:int,end:int,value:string>>")
    state = F.aggregate(
        parts,
        F.struct(F.lit(0).alias("at"), empty.alias("spans")),
        lambda s, p: F.struct(
            (s["at"] + p["gap"] + p["long"]).alias("at"),
            F.concat(
                s["spans"],
                F.array(
                    F.struct(
                        (s["at"] + p["gap"]).alias("start"),
                        F.lit(kind).alias("kind"),
                        (s["at"] + p["gap"] + p["long"]).alias("end"),
                        p["value"].alias("value"),
                    )
                ),
            ).cast("array<struct<start:int,kind:int,end:int,value:string>>").alias("spans"),
        ),
    )["spans"]
    kept = F.filter(state, lambda s: F.length(s["value"]) >= least)
    return F.when(text.rlike(pattern), kept).otherwise(empty)


def free_parts(run: Column, spans: Column, settings: Settings) -> Column:
    """The parts of a run that no span covers, if long enough; spans in order of their starts."""
    empty = F.array().cast("array<struct<start:int,end:int>>")

    def part(start: Column, end: Column) -> Column:
        own = F.array(F.struct(start.alias("start"), end.alias("end")))
        return F.when(end - start >= settings.candidate_chars, own).otherwise(empty)

    parts = F.aggregate(
        F.filter(spans, lambda b: (b["start"] < run["end"]) & (run["start"] < b["end"])),
        F.struct(run["start"].alias("at"), empty.alias("parts")),
        lambda s, b: F.struct(
            F.greatest(s["at"], b["end"]).alias("at"), F.concat(s["parts"], part(s["at"], b["start"])).alias("parts")
        ),
        lambda s: F.concat(s["parts"], part(s["at"], run["end"])),
    )
    return F.transform(
        parts,
        lambda p: F.struct(
            p["start"].alias("start"),
            run["kind"].alias("kind"),
            p["end"].alias("end"),
            F.substring(run["value"], p["start"] - run["start"] + 1, p["end"] - p["start"]).alias("value"),
        ),
    )


def total(values: Column) -> Column:
    return F.aggregate(values, F.lit(0.0), lambda a, b: a + b)


def stretches(items: Column, settings: Settings) -> Column:
    """Stretches (start, end) of neighbouring items with the largest sums.

    An item has a sum of its own and one that joins it to the item before. A stretch ends at its
    largest sum; another begins where nothing is left of it or ``in_all`` of it is lost.
    """
    empty = F.array().cast("array<struct<start:int,end:int>>")

    def ended(s: Column) -> Column:
        own = F.array(F.struct(s["start"].alias("start"), s["end"].alias("end")))
        return F.concat(s["out"], F.when(s["best"] > settings.per_char, own).otherwise(empty))

    def step(s: Column, item: Column) -> Column:
        fresh = (s["sum"] < 0) | (s["sum"] + item["join"] <= 0)
        now = item["own"] + F.when(fresh, 0.0).otherwise(s["sum"] + item["join"])
        above = fresh | (now > s["best"])
        # Lost too much: the next item begins another stretch.
        lost = ~fresh & (now < s["best"] - settings.in_all)
        return F.struct(
            F.when(lost, -1.0).otherwise(now).alias("sum"),
            F.when(fresh, item["start"]).otherwise(s["start"]).alias("start"),
            F.when(above, item["end"]).otherwise(s["end"]).alias("end"),
            F.when(above, now).otherwise(s["best"]).alias("best"),
            F.when(fresh, ended(s)).otherwise(s["out"]).alias("out"),
        )

    first = F.struct(
        F.lit(-1.0).alias("sum"), F.lit(0).alias("start"), F.lit(0).alias("end"), F.lit(-1.0).alias("best"), empty.alias("out")
    )
    return F.aggregate(items, first, step, ended)


def random_spans(run: Column, table: Column, settings: Settings) -> Column:
    """The run, if it is random as a whole, or else what is random in it; spans do not overlap."""
    empty = F.array().cast("array<struct<start:int,end:int>>")

    def let(value: Column, then) -> Column:
        return F.element_at(F.transform(F.array(value), then), 1)

    def passes(ratio: Column, chars: Column) -> Column:
        return (chars >= settings.candidate_chars) & (ratio > settings.in_all) & (ratio > settings.per_char * chars)

    def inside(ratios: Column) -> Column:
        # ratios[i] is that of the characters i and i + 1; a stretch gains by those above per_char.
        gains = F.transform(ratios, lambda r: r - settings.per_char)

        def item(start: Column, end: Column, own: Column, join: Column) -> Column:
            return F.struct(start.alias("start"), end.alias("end"), own.alias("own"), join.alias("join"))

        def of_words(words: Column) -> Column:
            def word(w: Column, i: Column) -> Column:
                before = F.when(i > 0, F.element_at(words, F.greatest(i, F.lit(1)))["end"])
                own = total(F.slice(gains, w["start"] + 1, w["end"] - w["start"] - 1))
                join = F.when(i > 0, total(F.slice(gains, before, w["start"] - before + 1))).otherwise(0.0)
                return item(w["start"], w["end"], own, join)

            alone = F.transform(words, lambda w: F.struct(w["start"].alias("start"), w["end"].alias("end")))
            return F.concat(stretches(F.transform(words, word), settings), alone)

        chars = F.concat(
            F.array(item(F.lit(0), F.lit(1), F.lit(0.0), F.lit(0.0))),
            F.transform(gains, lambda g, i: item(i + 1, i + 2, F.lit(0.0), g)),
        )
        found = F.concat(let(places(run["value"], "[A-Za-z0-9]+", 3), of_words), stretches(chars, settings))
        good = F.filter(
            found,
            lambda c: passes(total(F.slice(ratios, c["start"] + 1, c["end"] - c["start"] - 1)), c["end"] - c["start"]),
        )
        return F.aggregate(
            good,
            empty,
            lambda kept, c: F.when(
                F.exists(kept, lambda k: (k["start"] < c["end"]) & (c["start"] < k["end"])), kept
            ).otherwise(F.concat(kept, F.array(c))),
        )

    def within(ratios: Column) -> Column:
        whole = F.array(F.struct(F.lit(0).alias("start"), F.length(run["value"]).alias("end")))
        return F.when(passes(total(ratios), F.length(run["value"])), whole).otherwise(inside(ratios))

    ratios = F.transform(pairs(run["value"]), lambda p: F.element_at(table, p + 1))
    return F.transform(
        let(ratios, within),
        lambda c: F.struct(
            (run["start"] + c["start"]).alias("start"),
            run["kind"].alias("kind"),
            (run["start"] + c["end"]).alias("end"),
            F.substring(run["value"], c["start"] + 1, c["end"] - c["start"]).alias("value"),
        ),
    )


def scan(docs: DataFrame, ratios: list[float], settings: Settings = Settings(), text: str = "text") -> DataFrame:
    """Add ``base_spans`` and ``found_spans``: arrays of (start, kind, end, value), in order."""
    body = F.col("__body")
    table = F.from_json(F.lit(json.dumps(ratios)), "array<double>")
    spans = docs.withColumn("__body", F.coalesce(F.col(text), F.lit(""))).withColumns(
        {
            "__assign": places(body, ASSIGN, 0, group=1, least=8),
            "__access": places(body, ACCESS, 1),
            "__hex": places(body, HEX, 2),
            "__random": places(body, settings.candidates, 3),
        }
    )
    based = spans.withColumn("base_spans", F.array_sort(F.concat("__assign", "__access", "__hex")))

    more = F.flatten(
        F.transform(
            F.flatten(F.transform("__random", lambda run: free_parts(run, F.col("base_spans"), settings))),
            lambda run: random_spans(run, table, settings),
        )
    )
    return based.withColumn("found_spans", F.array_sort(F.concat("base_spans", more))).drop(
        "__body", "__assign", "__access", "__hex", "__random"
    )


def shown(spans: Column) -> Column:
    """kind:start:end, joined by commas."""
    names = F.array(*map(F.lit, KINDS))
    return F.array_join(
        F.transform(
            spans,
            lambda s: F.concat_ws(":", F.element_at(names, s["kind"] + 1), s["start"].cast("string"), s["end"].cast("string")),
        ),
        ",",
    )


def masked(scanned: DataFrame, text: str = "text", mark: str = "<secret>") -> DataFrame:
    """Put ``mark`` in the place of every group of overlapping spans; other texts stay as they are."""
    start = F.struct(F.lit(1).alias("at"), F.lit("").alias("out"))
    done = F.aggregate(
        "found_spans",
        start,
        lambda s, p: F.struct(
            F.greatest(s["at"], p["end"] + 1).alias("at"),
            F.when(
                p["start"] + 1 >= s["at"],
                F.concat(s["out"], F.substring(F.col(text), s["at"], p["start"] + 1 - s["at"]), F.lit(mark)),
            )
            .otherwise(s["out"])
            .alias("out"),
        ),
        lambda s: F.concat(s["out"], F.substring(F.col(text), s["at"], F.length(text))),
    )
    return scanned.withColumn(text, F.when(F.size("found_spans") > 0, done).otherwise(F.col(text)))


def digests(scanned: DataFrame) -> DataFrame:
    """Per document the counts and spans."""

    def count(kind: int) -> Column:
        return F.size(F.filter("base_spans", lambda s: s["kind"] == kind)).cast("long")

    return scanned.select(
        "doc_id",
        count(0).alias("n_assign"),
        count(1).alias("n_access"),
        count(2).alias("n_hex"),
        F.sha2(shown(F.col("base_spans")).cast("binary"), 256).alias("base_sha256"),
        shown(F.col("found_spans")).alias("spans"),
    )
