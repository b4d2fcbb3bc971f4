"""Personal data: patterns with checks, and boosted trees over candidates they don't cover.

Everything on the way from texts to spans is DataFrame expressions. Patterns with checks give the
base spans. Looser generators propose overlapping candidates; each candidate's format and context
fall into a few classes, so the whole corpus is counted in one aggregate with a bounded number
of cells. A cell's evidence (its normalised form, what it touches, the nearest context word) says
whether its candidates are personal data, whether or not a base pattern finds them too. Trees are
boosted on those cells and thresholds calibrated on the counts of the negative ones, both on the
driver, and what comes back to the tasks is one verdict per cell.

Spans are code points, end exclusive.
"""

from __future__ import annotations

import math
from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

KINDS = ("email", "ip", "card", "phone")

# Base patterns. Possessive forms match what plain ones would, without backtracking or recursion
# on long runs; \G lets a match begin right after the one before.
PATTERNS = {
    "email": r"(?:\G|(?<![A-Za-z0-9._%+-]))[A-Za-z0-9._%+-]++@[A-Za-z0-9-]++(?:\.[A-Za-z0-9-]++)++",
    "ip": r"(?:\G|(?<![0-9]))[0-9]++(?:\.[0-9]++){3}",
    "card": r"[0-9](?:[\x20-]?[0-9])++",
    "phone": r"\+[0-9][\x20().0-9-]+[0-9]",
}
_BYTE = r"0*(?:25[0-5]|2[0-4][0-9]|1[0-9]{2}|[0-9]{1,2})"
BYTES = rf"^{_BYTE}(?:\.{_BYTE}){{3}}$"

# Generators of candidates. They are wide on purpose: spaced, masked and unprefixed forms. Those of
# customary writing come first, so that a neighbouring number does not run into them.
_AT = r"(?:\x20?@\x20?|\x20?[(\[{<](?i:at)[)\]}>]\x20?|\x20(?i:at)\x20)"
_MASKED_DOT = r"(?:\x20?[(\[{<](?i:dot)[)\]}>]\x20?|\x20(?i:dot)\x20)"
_DOT = rf"(?:\.|{_MASKED_DOT})"
_NAME = r"[\p{L}0-9._%+-]{1,64}"
_SEP = r"[\x20./-]{1,2}"
_PHONE = (
    rf"(?:(?:\+?1{_SEP}?)?(?:\([0-9]{{3}}\)[\x20./-]{{0,2}}|[0-9]{{3}}{_SEP})[0-9]{{3}}{_SEP}[0-9]{{4}}"
    rf"|(?:\(0[1-9][0-9]{{0,3}}\)|0[1-9][0-9]{{0,3}})(?:{_SEP}[0-9]{{2,8}}){{1,5}}"
    r"|00[1-9][0-9]{0,2}(?:[\x20()./-]{1,3}[0-9]{1,8}){1,6})"
)
_CARD = (
    r"(?:[1-9][0-9]{3}([\x20./_-]{1,2})[0-9]{4}\1[0-9]{4}\1[0-9]{2,7}"
    r"|[1-9][0-9]{3}([\x20./_-]{1,2})[0-9]{6}\2[0-9]{4,5})"
)
GENERATORS = (
    ("email", rf"(?<![\p{{L}}0-9._%+-]){_NAME}(?:{_MASKED_DOT}{_NAME}){{0,3}}{_AT}"
              rf"[\p{{L}}0-9-]{{1,63}}(?:{_DOT}[\p{{L}}0-9-]{{1,63}})++"),
    ("ip", r"(?<![0-9])[0-9]{1,3}(?:\x20?\.\x20?[0-9]{1,3}){3}(?![0-9])"),
    ("card", rf"(?<![0-9]){_CARD}(?![0-9])"),
    ("card", r"(?<![0-9])[0-9](?:[\x20./_-]{0,2}[0-9]){12,21}+(?![0-9])"),
    ("phone", rf"(?<![0-9]){_PHONE}(?![0-9])"),
    ("phone", r"(?<![0-9])[+(]{0,2}[0-9](?:[\x20()./-]{0,3}[0-9]){6,14}+(?![0-9])"),
)

# What a candidate is told by; the number of cells is the product of the numbers of classes.
FEATURES = {
    "kind": len(KINDS), "digits": 6, "groups": 4, "separators": 4, "before": 5, "after": 4,
    "check": 3, "word": 3,
}
CELLS = math.prod(FEATURES.values())
CONTEXT = 24
# Context words of each kind, and those of numbers that are no personal data; the nearest counts.
_PRIVATE = {
    "email": r"e-?mail|mail|courriel|correo|contact|write|reach|reply|address",
    "ip": r"ip|host|server|client|node|address|ping|ssh",
    "card": r"card|carte|tarjeta|karte|visa|mastercard|amex|credit|debit|payment",
    "phone": r"phone|telephone|téléphone|teléfono|telefon|tel|tél|call|dial|fax|mobile|cell|contact|reach",
}
_TECHNICAL = (
    r"version|release|licen[sc]e|token|password|secret|key|isbn|ean|upc|sku|serial|id|uuid|hash|sha|"
    r"figure|section|chapter|order|invoice|tracking|ticket|account|ref|reference|batch|item|build|"
    r"commit|session|timestamp"
)
_TLD = (
    r"\.(?:com|org|net|edu|gov|mil|int|info|biz|name|pro|dev|app|xyz|example|test|eu|uk|us|de|fr|es|it"
    r"|nl|be|ch|at|au|ca|cn|jp|kr|in|br|mx|ar|cl|co|io|ai|me|tv|ru|pl|cz|se|no|dk|fi|pt|gr|ie|nz|za)$"
)
# Words before 'at' that are no names of mailboxes.
_NO_NAME = (
    r"^(?:us|me|him|her|them|it|you|we|is|are|be|visit|look|see|found|available|online|here|out|more|"
    r"directly|hosted|site|website|page)@"
)
_DATE = r"^\(?(?:(?:19|20)[0-9]{2}[\x20./-][0-9]{1,2}[\x20./-]|[0-9]{1,2}[\x20./-][0-9]{1,2}[\x20./-](?:19|20)[0-9]{2}(?![0-9]))"

ROUNDS, SHRINK, LEAF_WEIGHT = 60, 0.3, 1.0
# A kind's threshold lets through at most this share of its negatives (or none).
MAX_FALSE_SHARE = 0.001


def found(text: Column, pattern: str) -> Column:
    """Leftmost non-overlapping matches: array of (start, end, match), in order."""
    matches = F.regexp_extract_all(text, F.lit(pattern), F.lit(0))
    # What lies between the matches has the lengths that lead from one to the next.
    between = F.transform(F.split(text, pattern, -1), F.length)
    pairs = F.arrays_zip(matches.alias("match"), between.alias("gap"))
    empty = F.expr("cast(array() as array<struct<start: int, end: int, match: string>>)")

    def step(at: Column, pair: Column) -> Column:
        start = at["at"] + pair["gap"]
        end = start + F.length(pair["match"])
        span = F.struct(start.alias("start"), end.alias("end"), pair["match"].alias("match"))
        # The last gap has no match after it.
        return F.when(pair["match"].isNull(), at).otherwise(
            F.struct(end.alias("at"), F.concat(at["spans"], F.array(span)).alias("spans"))
        )

    first = F.struct(F.lit(0).alias("at"), empty.alias("spans"))
    return F.aggregate(pairs, first, step, lambda at: at["spans"])


def _digits(text: Column) -> Column:
    return F.regexp_replace(text, "[^0-9]", "")


def luhn(digits: Column) -> Column:
    """The check sum of a digit string: every second digit from the right is doubled."""

    def step(total: Column, i: Column) -> Column:
        d = F.ascii(F.substring(digits, F.length(digits) - i + 1, F.lit(1))) - 48
        twice = F.when(d > 4, 2 * d - 9).otherwise(2 * d)
        return total + F.when(i % 2 == 0, twice).otherwise(d)

    counted = F.aggregate(F.sequence(F.lit(1), F.length(digits)), F.lit(0), step)
    return (F.length(digits) > 0) & (counted % 10 == 0)


def _passes(kind: str, match: Column) -> Column:
    n = F.length(_digits(match))
    if kind == "ip":
        return match.rlike(BYTES)
    if kind == "card":
        return F.when(n.between(14, 19), luhn(_digits(match))).otherwise(False)
    return n.between(10, 15) if kind == "phone" else F.lit(True)


def _worth(kind: str, text: Column) -> Column:
    """Whether the kind's pattern can match at all."""
    return text.contains("@") if kind == "email" else text.rlike("[0-9]")


_NONE = "cast(array() as array<struct<start: int, kind: int, end: int>>)"
_NO_CANDIDATES = _NONE.replace("end: int", "end: int, rank: int, cell: int")


def base_spans(text: Column) -> Column:
    """Checked matches of the base patterns: array of (start, kind number, end), in that order."""

    def of(number: int, kind: str) -> Column:
        spans = F.filter(found(text, PATTERNS[kind]), lambda s: _passes(kind, s["match"]))
        short = F.transform(spans, lambda s: F.struct(
            s["start"].alias("start"), F.lit(number).alias("kind"), s["end"].alias("end")))
        return F.when(_worth(kind, text), short).otherwise(F.expr(_NONE))

    return F.sort_array(F.concat(*[of(i, k) for i, k in enumerate(KINDS)]))


def _class(value: Column, bounds: Sequence[int]) -> Column:
    """The number of bounds the value reaches."""
    return sum((F.when(value >= b, 1).otherwise(0) for b in bounds), F.lit(0))


def _check(kind: str, match: Column) -> Column:
    """0 where the normalised form is none of the kind, 2 where the writing is customary, else 1."""
    digits = _digits(match)
    n = F.length(digits)
    if kind == "email":
        address = F.lower(F.regexp_replace(F.regexp_replace(match, _AT, "@"), _DOT, "."))
        valid = address.rlike(r"^[\p{L}0-9._%+-]++@[\p{L}0-9-]++(?:\.[\p{L}0-9-]++)++$") & (
            address.rlike(r"\.\p{L}{2,24}$"))
        known = address.rlike(_TLD)
        spoken = match.rlike(r"\x20(?i:at)\x20")
        clear = match.rlike(r"[(\[{<](?i:at)[)\]}>]") | (known & (~spoken | match.rlike(_MASKED_DOT)))
        return F.when(~valid | (spoken & (~known | address.rlike(_NO_NAME))), 0).when(clear, 2).otherwise(1)
    if kind == "ip":
        valid = F.regexp_replace(match, r"\x20", "").rlike(BYTES)
        even = match.rlike(r"^[0-9]+(\x20?\.\x20?)[0-9]+\1[0-9]+\1[0-9]+$")
        # A list is numbered like '1. 2. 3. 4'.
        listed = match.rlike(r"\.\x20[0-9]|[0-9]\x20\.") & ~match.rlike(r"\x20\.\x20|[0-9]{3}")
        return F.when(~valid, 0).when(even & ~listed, 2).otherwise(1)
    if kind == "card":
        valid = n.between(13, 19) & ~digits.startswith("0")
        usual = (n > 13) & match.rlike(rf"^(?:{_CARD}|[0-9]+)$")
        return F.when(F.when(valid, luhn(digits)).otherwise(False), F.when(usual, 2).otherwise(1)).otherwise(0)
    usual = match.rlike(rf"^(?:{_PHONE}|\+.*)$")
    return F.when(~n.between(10, 15) | match.rlike(_DATE), 0).when(usual, 2).otherwise(1)


def _cell(kind: int, text: Column, span: Column) -> Column:
    """The number of the candidate's cell, from its format and its context."""
    name, match = KINDS[kind], span["match"]
    near = F.substring(text, F.greatest(span["start"] - CONTEXT, F.lit(0)) + 1,
                       F.least(span["start"], F.lit(CONTEXT)))
    following = F.substring(text, span["end"] + 1, F.lit(4))
    stripped = F.length(F.regexp_replace(match, r"[^\x20()./_@-]", ""))
    word = F.regexp_extract(
        near, rf"(?is)^.*(?<![\p{{L}}])({_PRIVATE[name]}|{_TECHNICAL})s?(?![\p{{L}}])", 1)
    goes_on = r"(?:\.|\x20\.\x20)" if name == "ip" else r"[./_-]"
    values = {
        "kind": F.lit(kind),
        "digits": _class(F.length(_digits(match)), (1, 7, 10, 13, 17)),
        "groups": _class(F.size(F.regexp_extract_all(match, F.lit("[0-9]+"), F.lit(0))), (2, 4, 6)),
        "separators": _class(stripped, (1, 3, 5)),
        "before": F.when(near == "", 0).when(near.rlike(r"[\p{L}0-9]$"), 2)
                   .when(near.rlike(rf"[0-9]{goes_on}$|[.+-]$"), 4)
                   .when(near.rlike(r"[=/#@&$€_\\]$"), 3).otherwise(1),
        "after": F.when(following == "", 0).when(following.rlike(r"^[\p{L}0-9]"), 2)
                  .when(following.rlike(rf"^{goes_on}[0-9]|^[-_/@=#%]"), 3).otherwise(1),
        "check": _check(name, match),
        "word": F.when(word == "", 0).when(word.rlike(rf"(?i)^(?:{_PRIVATE[name]})$"), 1).otherwise(2),
    }
    cell = F.lit(0)
    for feature, classes in FEATURES.items():
        cell = cell * classes + values[feature]
    return cell


def evidence(cell: int) -> bool | None:
    """Whether a cell's candidates are personal data, as far as form and context tell.

    A customary form needs no context, another valid one the nearest context word. Numbers that run
    on (parts of tokens and longer numbers), fail their check, or follow a technical word are none.
    Of a card number after a technical word neither is known.
    """
    c = dict(zip(FEATURES, classes_of(cell), strict=True))
    kind, check, word = KINDS[c["kind"]], c["check"], c["word"]
    if kind == "email":
        return check == 2 or (check == 1 and word == 1)
    runs_on = c["before"] in (2, 4) or c["after"] in (2, 3) or (c["before"] == 3 and word != 1)
    if not runs_on and kind == "card" and check == 2 and word == 2:
        return None
    return not runs_on and ((check == 2 and word != 2) or (check == 1 and word == 1))


def candidates(text: Column) -> Column:
    """All generators' spans: array of (start, kind number, end, rank of the generator, cell)."""

    def of(rank: int, kind: str, pattern: str) -> Column:
        number = KINDS.index(kind)
        spans = F.transform(found(text, pattern), lambda s: F.struct(
            s["start"].alias("start"), F.lit(number).alias("kind"), s["end"].alias("end"),
            F.lit(rank).alias("rank"), _cell(number, text, s).alias("cell")))
        # Only texts with both words or signs can hold a masked address.
        masked = text.rlike(_AT) & text.rlike(_DOT)
        worth = masked if kind == "email" else _worth(kind, text)
        return F.when(worth, spans).otherwise(F.expr(_NO_CANDIDATES))

    return F.concat(*[of(i, k, p) for i, (k, p) in enumerate(GENERATORS)])


def _meets(a: Column, b: Column) -> Column:
    return (a["start"] < b["end"]) & (b["start"] < a["end"])


def counted(docs: DataFrame) -> list[tuple[int, int, int]]:
    """Per cell the candidates that evidence tells to be personal data, and those that are none.

    At most CELLS rows come back. Candidates that meet only base spans of other kinds teach nothing
    about their own and are left out, and what a base pattern has found is no negative.
    """
    text = F.col("text")
    spans = docs.select("text").where(text.isNotNull()).select(
        base_spans(text).alias("base"), candidates(text).alias("candidates"))
    told = F.transform(F.col("candidates"), lambda c: F.struct(
        c["cell"].alias("cell"),
        F.exists("base", lambda b: _meets(b, c) & (b["kind"] == c["kind"])).alias("own"),
        F.exists("base", lambda b: _meets(b, c)).alias("taken")))
    rows = spans.select(F.explode(told).alias("c")).where("c.own or not c.taken")
    cells = rows.groupBy("c.cell").agg(
        F.count(F.lit(1)).alias("n"), F.sum((~F.col("c.taken")).cast("long")).alias("free"))
    known = [(r["cell"], evidence(r["cell"]), r["n"], r["free"]) for r in cells.collect()]
    counts = [(cell, n if good else 0, 0 if good else free)
              for cell, good, n, free in known if good is not None]
    return sorted((cell, good, bad) for cell, good, bad in counts if good or bad)


def classes_of(cell: int) -> tuple[int, ...]:
    values = []
    for classes in reversed(FEATURES.values()):
        cell, value = divmod(cell, classes)
        values.append(value)
    return tuple(reversed(values))


@dataclass(frozen=True)
class Split:
    """A tree of two levels: a test of one class, and a test with two values below each side."""

    test: tuple[int, int]
    below: tuple[tuple[tuple[int, int], float, float], ...]

    def value(self, classes: tuple[int, ...]) -> float:
        feature, bound = self.test
        (feature, bound), low, high = self.below[classes[feature] >= bound]
        return high if classes[feature] >= bound else low


_TESTS = [(i, b) for i, n in enumerate(FEATURES.values()) for b in range(1, n)]


def _best_test(rows: list[tuple]) -> tuple[float, tuple[int, int], float, float]:
    """The test that lowers the loss most, with the Newton step of each side."""

    def gain(g: float, h: float) -> float:
        return g * g / (h + LEAF_WEIGHT)

    all_g, all_h = sum(r[1] for r in rows), sum(r[2] for r in rows)
    best = (gain(all_g, all_h), (0, 0), 0.0, all_g / (all_h + LEAF_WEIGHT))
    for feature, bound in _TESTS:
        g = sum(r[1] for r in rows if r[0][feature] >= bound)
        h = sum(r[2] for r in rows if r[0][feature] >= bound)
        score = gain(g, h) + gain(all_g - g, all_h - h)
        if score > best[0] + 1e-12:
            low = (all_g - g) / (all_h - h + LEAF_WEIGHT)
            best = (score, (feature, bound), low, g / (h + LEAF_WEIGHT))
    return best


@dataclass(frozen=True)
class Model:
    """Boosted trees with the threshold of each kind (2: nothing of it is selected)."""

    prior: float
    trees: tuple[Split, ...]
    thresholds: tuple[float, ...]

    def probability(self, cell: int) -> float:
        classes = classes_of(cell)
        margin = self.prior + SHRINK * sum(t.value(classes) for t in self.trees)
        return 1 / (1 + math.exp(-max(-30.0, min(30.0, margin))))

    def verdicts(self) -> str:
        """One character per cell, 1 where a candidate of it is selected."""
        marks = []
        for cell in range(CELLS):
            kind = classes_of(cell)[0]
            chosen = self.thresholds[kind] <= 1 and self.probability(cell) >= self.thresholds[kind]
            marks.append("1" if chosen else "0")
        return "".join(marks)


def boosted(cells: list[tuple[int, int, int]]) -> tuple[float, tuple[Split, ...]]:
    """Trees for (cell, good, bad) counts by gradient boosting of the logistic loss.

    Counts weigh by their logarithm, so that a rare form is learned beside a very common one.
    """
    data = [(classes_of(c), math.log2(1 + g), math.log2(1 + b)) for c, g, b in sorted(cells)]
    good, bad = sum(d[1] for d in data), sum(d[2] for d in data)
    prior = math.log((good + 1) / (bad + 1))
    margins, trees = [prior] * len(data), []
    for _ in range(ROUNDS if good and bad else 0):
        rows = []
        for (classes, g, b), m in zip(data, margins, strict=True):
            p = 1 / (1 + math.exp(-max(-30.0, min(30.0, m))))
            rows.append((classes, g * (1 - p) - b * p, (g + b) * p * (1 - p)))
        feature, bound = _best_test(rows)[1]
        sides = [[], []]
        for r in rows:
            sides[r[0][feature] >= bound].append(r)
        below = tuple(_best_test(s)[1:] if s else ((0, 0), 0.0, 0.0) for s in sides)
        tree = Split((feature, bound), below)
        trees.append(tree)
        margins = [m + SHRINK * tree.value(d[0]) for m, d in zip(margins, data, strict=True)]
    return prior, tuple(trees)


def fit(docs: DataFrame) -> Model:
    """Trees and thresholds from the cells of the corpus.

    A kind's threshold is the lowest probability from 0.5 on at which the share of its negatives is
    within `MAX_FALSE_SHARE`; a kind without positives selects nothing. Verdicts are for the rows
    counted here, so the share is that of the corpus itself and not an estimate.
    """
    rows = counted(docs)
    prior, trees = boosted(rows)
    model = Model(prior, trees, (2.0,) * len(KINDS))
    thresholds = []
    for kind in range(len(KINDS)):
        told = [(model.probability(c), g, b) for c, g, b in rows if classes_of(c)[0] == kind]
        negatives, positives = sum(b for _, _, b in told), sum(g for _, g, _ in told)
        chosen, passed = 2.0, 0
        for p in sorted({p for p, _, _ in told if p >= 0.5}, reverse=True):
            passed += sum(b for q, _, b in told if q == p)
            if not positives or passed > MAX_FALSE_SHARE * negatives:
                break
            chosen = p
        # Nothing false from 0.5 on: cells without evidence are told by the trees alone.
        else:
            chosen = 0.5 if positives else 2.0
        thresholds.append(chosen)
    return Model(prior, trees, tuple(thresholds))


def with_spans(docs: DataFrame, model: Model) -> DataFrame:
    """Adds `base` and `spans`: arrays of (start, kind number, end) in that order.

    `spans` has the base spans and the selected candidates that meet no base span and no selected
    candidate of a generator listed before theirs. A NULL text counts as empty.
    """
    text, marks = F.coalesce("text", F.lit("")), F.lit(model.verdicts())
    chosen = F.filter(candidates(text), lambda c: F.substring(marks, c["cell"] + 1, F.lit(1)) == "1")
    told = docs.withColumn("__base", base_spans(text)).withColumn("__chosen", chosen)
    free = F.filter("__chosen", lambda c: ~F.exists("__base", lambda b: _meets(b, c)))
    told = told.withColumn("__chosen", free)
    first = F.filter("__chosen", lambda c: ~F.exists(
        "__chosen", lambda o: _meets(o, c) & (o["rank"] < c["rank"])))
    added = F.transform(first, lambda c: F.struct(
        c["start"].alias("start"), c["kind"].alias("kind"), c["end"].alias("end")))
    return told.withColumn("__spans", F.sort_array(F.concat("__base", added)))


def _written(spans: str) -> Column:
    kinds = F.array(*[F.lit(k) for k in KINDS])
    return F.array_join(F.transform(spans, lambda s: F.concat_ws(
        ":", F.get(kinds, s["kind"]), s["start"].cast("string"), s["end"].cast("string"))), ",")


def report(docs: DataFrame, model: Model) -> DataFrame:
    """Per row: doc_id, base spans of each kind, their digest, and all spans with their number."""
    told = with_spans(docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text"), model)

    def count(number: int) -> Column:
        return F.size(F.filter("__base", lambda s: s["kind"] == number)).cast("long")

    counts = [count(i).alias(f"n_{kind}") for i, kind in enumerate(KINDS)]
    return told.select(
        "doc_id", *counts, F.sha2(_written("__base").cast("binary"), 256).alias("base_sha256"),
        _written("__spans").alias("spans"), F.size("__spans").cast("long").alias("n_spans"),
    )


def redacted(docs: DataFrame, model: Model) -> DataFrame:
    """The rows with every span of `text` replaced by its kind in angle brackets.

    Spans that meet are replaced as one, by the kind of the first. A NULL text stays NULL.
    """
    tags = F.array(*[F.lit(f"<{k.upper()}>") for k in KINDS])
    text = F.col("text")

    def step(at: Column, s: Column) -> Column:
        between = F.substring(text, at["at"] + 1, s["start"] - at["at"])
        fresh = F.struct(
            s["end"].alias("at"),
            F.concat(at["parts"], F.array(between, F.get(tags, s["kind"]))).alias("parts"))
        longer = F.struct(F.greatest(at["at"], s["end"]).alias("at"), at["parts"].alias("parts"))
        return F.when(s["start"] >= at["at"], fresh).otherwise(longer)

    def finish(at: Column) -> Column:
        rest = F.substring(text, at["at"] + 1, F.length(text))
        return F.concat(F.array_join(at["parts"], ""), rest)

    first = F.struct(F.lit(0).alias("at"), F.expr("cast(array() as array<string>)").alias("parts"))
    clean = F.aggregate("__spans", first, step, finish)
    told = with_spans(docs, model).withColumn(
        "__text", F.when(F.size("__spans") > 0, clean).otherwise(text))
    return told.select(*[
        F.col("__text").alias("text") if c == "text" else F.col(f"`{c}`") for c in docs.columns
    ])
