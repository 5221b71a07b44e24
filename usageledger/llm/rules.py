"""Quality rules: a decision list learned from labelled text statistics.

Sequential covering: a rule is grown literal by literal (a literal compares one statistic with
one threshold) by FOIL gain on two thirds of the labelled rows, pruned on the other third, and
kept if it is precise; the rows it covers leave, and the next rule is learned. The list becomes
one ordered Spark CASE expression. One aggregate counts the labelled rows of every cell of
binned statistics; its rows, at most MAX_LABELLED, are all that covering looks at. There is no Python
on the executors.

Defined cases: a NULL or blank text has no words and fails the base rule; an empty table gives no
rows. A very long text is one row's array of words. Repeated rows get equal verdicts, row by row. A document labelled twice counts with its lowest quality; labels without a
document id or a quality are not used. Without usable labels there are no rules and the base
rule alone decides. Extra columns are carried along or ignored and cannot clash.
"""

from __future__ import annotations

import math
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from usageledger.llm.common import BLANKS, let, with_row

WINDOW = 8
# At most this many labelled rows, by a hash of the id, are learned from.
MAX_LABELLED = 20_000
CUTS = 16
MIN_COVERED = 4
MIN_PRECISION = 0.98


def _covered(windows: Column) -> Column:
    """Words lying in a window that occurs again: the union of the repeated windows."""

    def positions(ordered):
        def repeated(entry, i):
            before = F.get(ordered, i - 1)["k"] == entry["k"]
            after = F.get(ordered, i + 1)["k"] == entry["k"]
            return F.when(F.coalesce((i > 0) & before, F.lit(False)) | F.coalesce(after, F.lit(False)), entry["p"])

        return F.sort_array(F.filter(F.transform(ordered, repeated), lambda p: p.isNotNull()))

    def total(places):
        step = lambda p, i: F.least(F.lit(WINDOW), F.coalesce(F.get(places, i + 1) - p, F.lit(WINDOW)))
        return F.aggregate(F.transform(places, step), F.lit(0), lambda a, b: a + b)

    tagged = F.transform(windows, lambda k, i: F.struct(k.alias("k"), i.alias("p")))
    return let(F.sort_array(tagged), lambda ordered: let(positions(ordered), total))


def _repeat_words(hashes: Column) -> Column:
    windows = F.transform(F.sequence(F.lit(1), F.size(hashes) - (WINDOW - 1)), lambda i: F.xxhash64(F.slice(hashes, i, WINDOW)))
    counted = let(windows, lambda w: F.when(F.size(F.array_distinct(w)) == F.size(w), F.lit(0)).otherwise(_covered(w)))
    return F.when(F.size(hashes) > WINDOW, counted).otherwise(F.lit(0))


def _stuttered(hashes: Column) -> Column:
    same = F.filter(hashes, lambda h, i: (i > 0) & (F.get(hashes, i - 1) == h))
    return F.size(same)


def statistics(frame: DataFrame, text: str = "text") -> DataFrame:
    """`row` (the whole input row) and `s`, a struct of the text's counts, all long."""
    body = F.coalesce(frame[text], F.lit(""))
    split = with_row(
        frame,
        body=body,
        words=F.array_remove(F.split(body, r"[\x20\x09-\x0D]+"), ""),
        lines=F.filter(F.split(body, "\n"), lambda line: F.btrim(line, F.lit(BLANKS)) != ""),
    )
    counts = let(
        F.transform(F.col("words"), lambda w: F.xxhash64(w)),
        lambda h: F.struct(
            _repeat_words(h).alias("repeat"), _stuttered(h).alias("stutter")
        ),
    )
    kept_only = lambda pattern: F.length(F.regexp_replace("body", pattern, ""))
    counted = split.select(
        "row",
        counts.alias("c"),
        F.size("words").alias("n_words"),
        F.length(F.array_join("words", "")).alias("word_chars"),
        kept_only(r"[^#*$%&|<>]+").alias("n_symbols"),
        kept_only(r"[^\p{Lu}]+").alias("n_upper"),
        F.size("lines").alias("n_lines"),
        (F.size("lines") - F.size(F.array_distinct("lines"))).alias("n_dup_lines"),
    )
    whole = {
        "n_words": "n_words", "word_chars": "word_chars", "n_symbols": "n_symbols", "n_upper": "n_upper", "n_lines": "n_lines",
        "n_dup_lines": "n_dup_lines", "n_repeat_words": "c.repeat", "n_stutter": "c.stutter",
    }
    return counted.select("row", F.struct(*[F.col(c).cast("long").alias(n) for n, c in whole.items()]).alias("s"))


def _ratios(s: Column) -> dict[str, Column]:
    """The features that rules compare; none of them drifts with the length of a clean text."""
    over = lambda a, b: F.coalesce(F.try_divide(s[a].cast("double"), s[b].cast("double")), F.lit(0.0))
    return {
        "word_length": over("word_chars", "n_words"),
        "symbols": over("n_symbols", "n_words"),
        "upper": over("n_upper", "word_chars"),
        "dup_lines": over("n_dup_lines", "n_lines"),
        "repeated": over("n_repeat_words", "n_words"),
        "stutter": over("n_stutter", "n_words"),
    }


def base_failed(s: Column) -> Column:
    return (s["n_words"] < 20) | (100 * s["n_repeat_words"] > 30 * s["n_words"])


@dataclass(frozen=True)
class Literal:
    feature: str
    at_least: bool
    cut: float

    def column(self, ratios: dict[str, Column]) -> Column:
        return ratios[self.feature] >= self.cut if self.at_least else ratios[self.feature] < self.cut

    def __str__(self) -> str:
        return f"{self.feature} {'>=' if self.at_least else '<'} {self.cut:.6g}"


@dataclass(frozen=True)
class Rule:
    literals: tuple[Literal, ...]

    def column(self, ratios: dict[str, Column]) -> Column:
        out = F.lit(True)
        for literal in self.literals:
            out = out & literal.column(ratios)
        return out

    def __str__(self) -> str:
        return " and ".join(map(str, self.literals))


def fired(rules: list[Rule], s: Column) -> Column:
    """The first rule that holds, as text, by one ordered CASE; NULL where none does."""
    ratios = _ratios(s)
    out = F.lit(None).cast("string")
    for rule in reversed(rules):
        out = F.when(rule.column(ratios), F.lit(str(rule))).otherwise(out)
    return out


def labelled_sample(labels: DataFrame, limit: int = MAX_LABELLED) -> DataFrame:
    """(doc_id, bad) of at most `limit` labelled documents, chosen by a hash of the id."""
    usable = labels.where(labels["doc_id"].isNotNull() & labels["quality"].isNotNull())
    worst = usable.groupBy(usable["doc_id"].alias("doc_id")).agg((F.min(usable["quality"]) == 0).cast("int").alias("bad"))
    return worst.orderBy(F.xxhash64("doc_id"), "doc_id").limit(limit)


def _gain(p: int, n: int, p0: int, n0: int) -> float:
    return p * (math.log2(p / (p + n)) - math.log2(p0 / (p0 + n0))) if p else 0.0


def _cells(labelled: DataFrame) -> tuple[dict[str, list[float]], list[dict]]:
    """The cuts of every feature, and bad and good rows by cell: a bin of each feature, held out or not."""
    ratios = _ratios(F.col("s"))
    held = F.pmod(F.xxhash64("doc_id", F.lit(7)), F.lit(3)) == 0
    facts = labelled.select("bad", held.alias("held"), *[c.alias(n) for n, c in ratios.items()]).persist()
    try:
        share = [(i + 0.5) / CUTS for i in range(CUTS)]
        # Exact, so that every run learns the same rules; the sample is bounded.
        parts = facts.groupBy("bad").agg(*[F.percentile(n, share).alias(n) for n in ratios]).collect()
        cuts = {n: sorted({x for part in parts for x in (part[n] or [])}) for n in ratios}

        def bin_of(name: str) -> Column:
            """The number of cuts that the value reaches."""
            return F.size(F.filter(F.array(*[F.lit(x) for x in cuts[name]]), lambda x: x <= F.col(name))).alias(name)

        counted = facts.groupBy("held", *[bin_of(n) for n in ratios if cuts[n]]).agg(F.sum("bad").alias("p"), F.sum(1 - F.col("bad")).alias("n"))
        return cuts, [r.asDict() for r in counted.collect()] if parts else []
    finally:
        facts.unpersist()


def _counts(cells: list[dict]) -> tuple[int, int]:
    return sum(c["p"] for c in cells), sum(c["n"] for c in cells)


def learn(labelled: DataFrame) -> list[Rule]:
    """Rules for `bad` from labelled statistics (`s`, `bad`, `doc_id`).

    No number of rules or literals is set: a rule grows while a literal gains and wrong rows are
    left, and rules follow while one covers MIN_COVERED bad rows with MIN_PRECISION, in all rows
    and in the held-out ones, which no literal was chosen by.
    """
    cuts, rest = _cells(labelled)

    def holds(literal: Literal, cell: dict) -> bool:
        reached = cell[literal.feature] > cuts[literal.feature].index(literal.cut)
        return reached == literal.at_least

    def where(literals: list[Literal], cells: list[dict]) -> list[dict]:
        for literal in literals:
            cells = [c for c in cells if holds(literal, c)]
        return cells

    def best(cells: list[dict]) -> Literal | None:
        p0, n0 = _counts(cells)
        top: tuple[float, Literal | None] = (1e-9, None)
        for name in cuts if p0 and n0 else ():
            by_bin = [[0, 0] for _ in range(len(cuts[name]) + 1)]
            for c in cells:
                by_bin[c[name]][0] += c["p"]
                by_bin[c[name]][1] += c["n"]
            below_p = below_n = 0
            for cut, (p, n) in zip(cuts[name], by_bin[:-1], strict=True):
                below_p, below_n = below_p + p, below_n + n
                for literal, q, m in ((Literal(name, True, cut), p0 - below_p, n0 - below_n), (Literal(name, False, cut), below_p, below_n)):
                    if (gain := _gain(q, m, p0, n0)) > top[0]:
                        top = (gain, literal)
        return top[1]

    def worth(literals: list[Literal]) -> float:
        p, n = _counts(where(literals, [c for c in rest if c["held"]]))
        return (p - n) / max(1, p + n)

    rules: list[Rule] = []
    while rest:
        literals: list[Literal] = []
        growing = [c for c in rest if not c["held"]]
        # A literal with a gain leaves out a cell at least, so that growing ends.
        while (literal := best(growing)) is not None:
            literals.append(literal)
            growing = where([literal], growing)
        if not literals:
            break
        k = max(range(1, len(literals) + 1), key=lambda k: (worth(literals[:k]), -k))
        covered = where(literals[:k], rest)
        p, n = _counts(covered)
        held_p, held_n = _counts([c for c in covered if c["held"]])
        precise = p >= MIN_PRECISION * (p + n) and held_p >= max(1, MIN_PRECISION * (held_p + held_n))
        if p < MIN_COVERED or not precise:
            break
        rules.append(Rule(tuple(literals[:k])))
        gone = set(map(id, covered))
        rest = [c for c in rest if id(c) not in gone]
    return rules


def fit(docs: DataFrame, labels: DataFrame, doc_id: str = "doc_id", text: str = "text", limit: int = MAX_LABELLED) -> list[Rule]:
    """Learn rules from the labelled documents; the sample is bounded, so it may be broadcast."""
    chosen = labelled_sample(labels, limit)
    texts = docs.select(docs[doc_id].alias("doc_id"), docs[text].alias("text")).join(F.broadcast(chosen), "doc_id")
    return learn(statistics(texts).select(F.col("row.doc_id").alias("doc_id"), F.col("row.bad").alias("bad"), "s"))


def judged(docs: DataFrame, labels: DataFrame, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """Every document as `row` with its counts `s`, the rule that fired, `failed` and `kept`."""
    rules = fit(docs, labels, doc_id, text)
    scored = statistics(docs, text).select("row", "s", base_failed(F.col("s")).alias("failed"), fired(rules, F.col("s")).alias("rule"))
    return scored.withColumn("kept", ~F.col("failed") & F.col("rule").isNull())
