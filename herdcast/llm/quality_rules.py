"""Quality rules as a short-circuit cascade, in DataFrame functions only.

A document passes when none of the rules rejects it. Which rule rejects it does not change the
result, so rules may run in any order: each is timed and counted on a sample, and those that
reject most per second go first. One CASE expression then stops at the first rejection.
"""

from __future__ import annotations

import time
from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from herdcast.llm.common import let, pick, words_of

SYMBOLS = "#*$%&|<>"
#: Frequent function words of the languages in use.
STOP_WORDS = ("the of and to in is that for it with by this der die und das den von zu mit ist nicht "
              "le la les de et des du un une en que qui el los las y del por con para se").split()
#: Up to so many repeated windows are looked up one by one; beyond, all windows are sorted with their places.
FEW = 16


@dataclass(frozen=True)
class Rule:
    """``fails`` takes the words, the text and the struct of base counts."""

    name: str
    fails: Callable[[Column, Column, Column], Column]


def _capitals(w: Column, t: Column, b: Column) -> Column:
    return 100 * (F.size(F.split(t, "[A-Z]")) - 1) > 30 * b["word_chars"]


def _few_stop_words(w: Column, t: Column, b: Column) -> Column:
    return F.size(F.array_intersect(w, F.array(*[F.lit(x) for x in STOP_WORDS]))) < 2


RULES = (
    Rule("symbols", lambda w, t, b: 10 * b["n_symbols"] > b["n_words"]),
    Rule("word_length", lambda w, t, b: (b["word_chars"] < 3 * b["n_words"]) | (b["word_chars"] > 10 * b["n_words"])),
    Rule("repeated_lines", lambda w, t, b: 2 * b["n_dup_lines"] > b["n_lines"]),
    Rule("capitals", _capitals),
    Rule("stop_words", _few_stop_words),
)


def _covered(places: Column) -> Column:
    """Words under three-word windows that start at these places (ascending)."""
    return let(places, lambda p: F.aggregate(
        F.transform(p, lambda x, i: F.least(F.lit(3), F.coalesce(F.get(p, i + 1) - x, F.lit(3)))),
        F.lit(0), lambda a, x: a + x))


def repeated_words(words: Column) -> Column:
    """Words inside three-word windows that occur twice or more. Windows are compared by 64-bit hash."""
    def count(h: Column, twice: Column) -> Column:
        few = F.filter(F.transform(h, lambda x, i: F.when(F.array_contains(twice, x), i)), lambda i: i.isNotNull())
        ranked = F.sort_array(F.transform(h, lambda x, i: F.struct(x.alias("h"), i.alias("p"))))
        many = let(ranked, lambda s: F.filter(
            s, lambda e, i: F.coalesce(F.get(s, i - 1)["h"] == e["h"], F.lit(False))
            | F.coalesce(F.get(s, i + 1)["h"] == e["h"], F.lit(False))))
        return (F.when(F.size(twice) == 0, F.lit(0)).when(F.size(twice) <= FEW, _covered(few))
                .otherwise(_covered(F.sort_array(F.transform(many, lambda e: e["p"])))))

    def again(h: Column) -> Column:
        return let(F.sort_array(h), lambda s: F.array_distinct(F.filter(
            s, lambda x, i: F.coalesce(F.get(s, i - 1) == x, F.lit(False)))))

    windows = F.transform(F.sequence(F.lit(0), F.size(words) - 3),
                          lambda i: F.xxhash64(F.get(words, i), F.get(words, i + 1), F.get(words, i + 2)))
    return F.when(F.size(words) < 4, F.lit(0)).otherwise(
        let(windows, lambda h: F.when(F.size(F.array_distinct(h)) == F.size(h), F.lit(0))
            .otherwise(let(again(h), lambda twice: count(h, twice)))))


BASE = ("n_words", "word_chars", "n_symbols", "n_lines", "n_dup_lines", "n_repeat_words")


def base_counts(words: Column, text: Column) -> Column:
    """The base counts as one struct. Arrays are bound once by ``let``, so no optimiser rule can
    copy their computation into the loops over them."""
    lines = F.filter(F.split(text, "\n"), lambda x: x.rlike(r"[^\x20\x09-\x0D]"))
    return let(lines, lambda ls: F.struct(*[c.cast("long").alias(n) for c, n in zip(
        (F.size(words), F.length(F.concat_ws("", words)), F.size(F.split(text, f"[{SYMBOLS}]")) - 1,
         F.size(ls), F.size(ls) - F.size(F.array_distinct(ls)), repeated_words(words)), BASE, strict=True)]))


def _texts(docs: DataFrame) -> DataFrame:
    return pick(docs, "doc_id", "text").select("doc_id", F.coalesce("text", F.lit("")).alias("text"))


def base_failed(b: Column) -> Column:
    return (b["n_words"] < 50) | (100 * b["n_repeat_words"] > 50 * b["n_words"])


def order_rules(docs: DataFrame, rules: tuple[Rule, ...] = RULES, sample_rows: int = 1500) -> list[Rule]:
    """The rules, most rejections per second first, as measured on about ``sample_rows`` documents.

    The sample only settles the order. It is picked by hash, so it is the same on every run.
    """
    text = F.col("text")
    share = min(1.0, sample_rows / max(1, docs.count()))
    held = (_texts(docs).where(F.pmod(F.xxhash64("doc_id", F.lit("rules")), F.lit(1_000_000)) < int(share * 1_000_000))
            .select("text", let(words_of(text), lambda w: F.struct(w.alias("w"), base_counts(w, text).alias("b"))).alias("r"))
            .persist())
    w, b = F.col("r.w"), F.col("r.b")
    base = held.where(~base_failed(b))
    rows = max(1, base.count())

    def run(fails: Column) -> tuple[float, int]:
        start = time.perf_counter()
        hits = base.agg(F.count_if(fails).alias("n")).first()["n"]
        return time.perf_counter() - start, hits

    idle = min(run(b["n_words"] < 0)[0] for _ in range(2))
    scored = []
    for rule in rules:
        seconds, hits = min(run(rule.fails(w, text, b)) for _ in range(2))
        scored.append((hits / rows / max(seconds - idle, 1e-3), rule))
    held.unpersist()
    return [rule for _, rule in sorted(scored, key=lambda x: -x[0])]


def apply_rules(docs: DataFrame, rules: list[Rule] | tuple[Rule, ...]) -> DataFrame:
    """Per document: the base counts, ``base_failed`` and ``kept``.

    A null or empty text has no words and fails the base. A null id stays null. Repeated rows
    are judged one by one, to the same result. Other columns are ignored.
    """
    text = F.col("text")

    def judged(w: Column) -> Column:
        def verdict(b: Column) -> Column:
            case = F.when(base_failed(b), F.lit(False))
            for rule in rules:
                case = case.when(rule.fails(w, text, b), F.lit(False))
            return F.struct(b.alias("b"), base_failed(b).alias("base_failed"), case.otherwise(F.lit(True)).alias("kept"))
        return let(base_counts(w, text), verdict)

    return _texts(docs).select("doc_id", let(words_of(text), judged).alias("r")).select(
        "doc_id", *[F.col(f"r.b.{n}").alias(n) for n in BASE if n != "n_lines"], "r.base_failed", "r.kept")


def quality_rules(docs: DataFrame, rules: tuple[Rule, ...] = RULES, sample_rows: int = 1500) -> DataFrame:
    """``apply_rules`` in the order that ``order_rules`` finds."""
    return apply_rules(docs, order_rules(docs, rules, sample_rows))
