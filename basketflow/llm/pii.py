"""Personal data: proposed spans, boosted trees, calibrated thresholds. DataFrame functions only.

Four patterns give the base spans (e-mail, IPv4, card, phone), leftmost and without overlap within a kind;
they always stand. High-recall generators, looser forms of the same kinds, propose further spans, which
may overlap others. Boosted trees of depth two score every proposal by format (digits, separators,
Luhn, parts) and context (neighbouring characters, cue words before it).

What they learn is which loose forms are personal data though no base pattern takes them. Positives are base matches of
the texts, rewritten in their place into the forms people use to hide or shorten them: ``name [at] host``, ``1[.]2[.]3[.]4``,
card groups between dots, ``0049`` for ``+49``. Negatives are the texts' own proposals that meet no base span of their
kind. Signs that define a base rule (a plus, an at sign with a domain) are no features; those that a loose form keeps are. The
features are small integers, so equal ones are counted together in Spark, and only the ``CELLS`` most
frequent combinations are collected to grow the trees. For each kind a threshold is set on a held-out
quarter of the texts so that at least ``PRECISION`` of the selected proposals are positives. It is taken
from all proposals of that quarter, however rare: Spark counts them by kind and rounded margin, and of these
counts at most ``TOP`` a kind are collected. Proposals of the texts above it that meet no base span of their kind are added.

Places are running sums taken in chunks, base spans are found by bisection, and a text is cut as an array of its
characters, so the work stays near linear in a text's length and matches.

Patterns are run with possessive loops and look-behinds, which find the same matches in time linear in
the text and without deep recursion, however long a run of digits or letters is.

Defined results: a null text is an empty one without spans; repeated rows are judged one by one, alike;
without proposals (an empty table too) there is no model and base spans alone stand. Offsets count
code points, end exclusive. Added columns get free names.
"""

from __future__ import annotations

import math
from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from basketflow.llm.base import fresh, stored, table, text_of

KINDS = ("email", "ip", "card", "phone")
#: Base patterns; the same matches as the plain forms.
BASE = {
    "email": r"(?:\G|(?<![A-Za-z0-9._%+-]))[A-Za-z0-9._%+-]++@[A-Za-z0-9-]++(?:\.[A-Za-z0-9-]++)++",
    "ip": r"(?<![0-9])[0-9]++(?:\.[0-9]++){3}",
    "card": r"[0-9](?:[\x20-]?[0-9])++",
    "phone": r"\+[0-9][\x20().0-9-]+[0-9]",
}
#: Generators: anything that may be of the kind.
LOOSE = {
    "email": r"(?:\G|(?<![^\s@]))[^\s@]++(?:@|\s?[\[(]\s?at\s?[\])]\s?)[^\s@]++",
    "ip": r"(?<![0-9.])[0-9]++(?:(?:\.|\[\.\])[0-9]++)++",
    "card": r"(?<![0-9])[0-9](?:[\x20./_-]{0,2}[0-9])++",
    "phone": r"(?:\+|00)?[(]?[0-9](?:[\x20()./-]{0,3}[0-9])++",
}
#: A text without a match has no span of the kind.
NEEDS = {"email": r"@|[\[(]\s?at", "ip": r"[0-9](?:\.|\[\.\])[0-9]", "card": r"[0-9][\x20./_-]?[0-9]", "phone": r"[0-9]"}
CUES = r"(?i)(mail|contact|write|tel|phone|call|fax|mobil|card|visa|pay|ip|addr|host|server)\W{0,3}\w{0,6}\W{0,3}$"
OCTET = r"0*(?:25[0-5]|2[0-4][0-9]|1[0-9][0-9]|[0-9]{1,2})"
FEATURES = ("kind", "digits", "width", "parts", "luhn", "octets", "zeros", "bracket", "dotted", "host", "left", "right", "cue")
#: Elements of an array that a running sum copies at a time.
CHUNK = 64
#: Combinations of features that the trees are grown on; thresholds take all of them.
CELLS = 4096
ROUNDS = 10
#: The margin of a kind without positives.
NEVER = -100.0
RATE = 0.4
PRECISION = 0.99
#: Margins are rounded up to parts of ``STEP``; those beyond ``TOP`` such parts count as one.
STEP = 128
TOP = 4096
CALIBRATE = 4


def _let(value: Column, then: Callable[[Column], Column]) -> Column:
    return F.transform(F.array(value), then)[0]


def _digits(match: Column) -> Column:
    return F.regexp_replace(match, "[^0-9]", "")


def valid(kind: str, match: Column) -> Column:
    """Whether a match of the base pattern stands."""
    if kind == "ip":
        return match.rlike(rf"^{OCTET}(?:\.{OCTET}){{3}}$")
    n = F.char_length(_digits(match))
    if kind == "card":
        return n.between(16, 19) & luhn(_digits(match))
    if kind == "phone":
        return n.between(8, 15)
    return F.lit(True)


def luhn(digits: Column) -> Column:
    return F.coalesce(F.call_function("luhn_check", digits), F.lit(False))


def scanned(items: Column, init: Column, step: Callable, emit: Callable, kind: str) -> Column:
    """``emit(state, item)`` of each item, in order, where ``step`` carries the state along. An aggregate copies its
    result for each item; so the states are taken at every ``CHUNK`` items first, and each chunk from its own."""
    chunks = F.sequence(F.lit(0), F.ceil(F.size(items) / CHUNK).cast("int") - 1)

    def chunk(c: Column) -> Column:
        return F.slice(items, c * CHUNK + 1, F.lit(CHUNK))

    def next_chunk(done: Column, c: Column) -> Column:
        state = F.aggregate(chunk(c), done["state"], step)
        return F.struct(state.alias("state"), F.concat(done["begins"], F.array(done["state"])).alias("begins"))

    def within(begin: Column, c: Column) -> Column:
        def next_item(done: Column, x: Column) -> Column:
            return F.struct(step(done["state"], x).alias("state"), F.concat(done["out"], F.array(emit(done["state"], x))).alias("out"))

        return F.aggregate(chunk(c), F.struct(begin.alias("state"), F.array().cast(kind).alias("out")), next_item)["out"]

    start = F.struct(init.alias("state"), F.slice(F.array(init), 1, 0).alias("begins"))
    begins = F.aggregate(chunks, start, next_chunk)["begins"]
    return F.when(F.size(items) > 0, F.flatten(F.transform(begins, within))).otherwise(F.array().cast(kind))


_PLACES = "array<struct<start:int,end:int>>"


def placed(gaps_and_widths: Column) -> Column:
    """``start, end`` of things that follow each other with gaps between them (``gap, width``)."""
    return scanned(
        gaps_and_widths,
        F.lit(0),
        lambda at, x: at + x["gap"] + x["width"],
        lambda at, x: F.struct((at + x["gap"]).alias("start"), (at + x["gap"] + x["width"]).alias("end")),
        _PLACES,
    )


def located(text: Column, pattern: str, needs: str) -> Column:
    """All matches with their places and up to 24 characters on either side."""
    kind = "array<struct<start:int,end:int,match:string,before:string,after:string>>"

    def walk(x: Column) -> Column:
        sizes = F.transform(x["hits"], lambda hit, i: F.struct(F.char_length(F.get(x["parts"], i)).alias("gap"), F.char_length(hit).alias("width")))

        def one(place: Column, i: Column) -> Column:
            return F.struct(
                place["start"].alias("start"), place["end"].alias("end"), F.get(x["hits"], i).alias("match"),
                F.right(F.get(x["parts"], i), F.lit(24)).alias("before"), F.left(F.get(x["parts"], i + 1), F.lit(1)).alias("after"),
            )

        return _let(_let(sizes, placed), lambda places: F.transform(places, one))

    split = F.struct(F.split(text, pattern, -1).alias("parts"), F.regexp_extract_all(text, F.lit(pattern), F.lit(0)).alias("hits"))
    found = _let(split, lambda x: F.when(F.size(x["hits"]) > 0, walk(x)).otherwise(F.array().cast(kind)))
    return F.when(text.rlike(needs), found).otherwise(F.array().cast(kind))


def meets(spans: Column, m: Column) -> Column:
    """Whether a span overlaps one of ``spans``, which are in order and apart; by bisection."""
    n = F.size(spans)

    def half(s: Column, _: Column) -> Column:
        middle = F.floor((s["low"] + s["high"]) / 2).cast("int")
        ends = F.get(spans, middle)["end"] <= m["start"]
        inside = s["low"] < s["high"]
        return F.struct(
            F.when(inside & ends, middle + 1).otherwise(s["low"]).alias("low"),
            F.when(inside & ~ends, middle).otherwise(s["high"]).alias("high"),
        )

    first = F.aggregate(F.sequence(F.lit(0), F.ceil(F.log2(n + 1)).cast("int")), F.struct(F.lit(0).alias("low"), n.alias("high")), half)["low"]
    return F.when(n == 0, F.lit(False)).otherwise(F.coalesce(_let(first, lambda at: F.get(spans, at)["start"] < m["end"]), F.lit(False)))


def characters(text: Column) -> Column:
    """The code points of a text. A part of a string is counted out from its begin each time, a part of an array is not."""
    return F.regexp_extract_all(text, F.lit("(?s)."), F.lit(0))


def _between(chars: Column, start: Column, end: Column) -> Column:
    return F.array_join(F.slice(chars, start + 1, F.greatest(end - start, F.lit(0))), "")


def _base_of(i: int, text: Column) -> Column:
    stands = F.filter(located(text, BASE[KINDS[i]], NEEDS[KINDS[i]]), lambda m: valid(KINDS[i], m["match"]))
    return F.transform(stands, lambda m: F.struct(F.lit(i).alias("kind"), m["start"].alias("start"), m["end"].alias("end")))


def base_spans(text: Column) -> Column:
    """``kind, start, end`` of all base spans, by kind as listed, then start."""
    return F.concat(*[_base_of(i, text) for i in range(len(KINDS))])


def _side(char: Column) -> Column:
    return (
        F.when(char == "", 0).when(char.rlike(r"^\s"), 1).when(char.rlike(r"^\p{L}"), 2).when(char.rlike("^[0-9]"), 3).otherwise(4)
    )


def _features(kind: int, m: Column) -> list[Column]:
    digits = _digits(m["match"])
    by_name = {
        "kind": F.lit(kind),
        "digits": F.least(F.char_length(digits), F.lit(24)),
        "width": F.least(F.floor(F.char_length(m["match"]) / 4).cast("int"), F.lit(12)),
        "parts": F.least(F.size(F.split(m["match"], r"[^0-9A-Za-z]+")), F.lit(9)),
        "luhn": luhn(digits).cast("int"),
        "octets": F.replace(m["match"], F.lit("[.]"), F.lit(".")).rlike(rf"^{OCTET}(?:\.{OCTET}){{3}}$").cast("int"),
        "zeros": m["match"].startswith("00").cast("int"),
        "bracket": m["match"].rlike(r"[\[(]").cast("int"),
        "dotted": m["match"].contains(".").cast("int"),
        "host": m["match"].rlike(r"[\])]\s?[A-Za-z0-9-]+(?:\.[A-Za-z0-9-]+)*\.[A-Za-z]{2,}$").cast("int"),
        "left": _side(F.right(m["before"], F.lit(1))),
        "right": _side(m["after"]),
        "cue": m["before"].rlike(CUES).cast("int"),
    }
    return [by_name[name].cast("int").alias(name) for name in FEATURES]


def _proposals_of(i: int, text: Column, spans: Column) -> Column:
    """A generator's spans with their features and whether they meet one of the spans, which are of its kind."""
    def proposal(m: Column) -> Column:
        return F.struct(m["start"].alias("start"), m["end"].alias("end"), meets(spans, m).alias("met"), *_features(i, m))

    return F.transform(located(text, LOOSE[KINDS[i]], NEEDS[KINDS[i]]), proposal)


def _own(base: Column, i: int) -> Column:
    return F.filter(base, lambda b: b["kind"] == i)


def proposals(text: Column, base: Column) -> Column:
    """Every generator's spans with their features and whether they meet a base span of the kind."""
    def of(i: int) -> Column:
        return _let(_own(base, i), lambda spans: _proposals_of(i, text, spans))

    return F.concat(*[of(i) for i in range(len(KINDS))])


def loosened(kind: str, match: Column) -> Column:
    """A base match in a form that no base pattern takes."""
    if kind == "email":
        return F.replace(match, F.lit("@"), F.lit(" [at] "))
    if kind == "ip":
        return F.replace(match, F.lit("."), F.lit("[.]"))
    if kind == "card":
        return F.regexp_replace(_digits(match), "([0-9]{4})(?=[0-9])", "$1.")
    return F.regexp_replace(match, r"^\+", "00")


def rewritten(i: int, text: Column, spans: Column) -> Column:
    """``text, spans`` with the spans of a kind in loose form, and where these are."""
    def cut(chars: Column) -> Column:
        def one(b: Column, k: Column) -> Column:
            before = F.when(k > 0, F.get(spans, F.greatest(k - 1, F.lit(0)))["end"]).otherwise(0)
            return F.struct(_between(chars, before, b["start"]).alias("gap"), loosened(KINDS[i], _between(chars, b["start"], b["end"])).alias("match"))

        tail = _between(chars, F.element_at(spans, -1)["end"], F.size(chars))
        return F.struct(F.transform(spans, one).alias("pieces"), tail.alias("tail"))

    def joined(x: Column) -> Column:
        sizes = F.transform(x["pieces"], lambda p: F.struct(F.char_length(p["gap"]).alias("gap"), F.char_length(p["match"]).alias("width")))
        whole = F.concat(F.array_join(F.transform(x["pieces"], lambda p: F.concat(p["gap"], p["match"])), ""), x["tail"])
        return F.struct(whole.alias("text"), _let(sizes, placed).alias("spans"))

    return _let(_let(characters(text), cut), joined)


_EXAMPLES = "array<struct<" + ",".join(f"{name}:int" for name in FEATURES) + ",positive:boolean>>"


def examples(text: Column, base: Column) -> Column:
    """What the trees learn from: features and whether the proposal is personal data."""
    def shown(found: Column, positive: bool) -> Column:
        return F.transform(found, lambda p: F.struct(*[p[name].alias(name) for name in FEATURES], F.lit(positive).alias("positive")))

    def of(i: int) -> Column:
        def both(spans: Column) -> Column:
            own = shown(F.filter(_proposals_of(i, text, spans), lambda p: ~p["met"]), False)
            loose = F.when(
                F.size(spans) > 0,
                _let(rewritten(i, text, spans), lambda r: shown(F.filter(_proposals_of(i, r["text"], r["spans"]), lambda p: p["met"]), True)),
            ).otherwise(F.array().cast(_EXAMPLES))
            return F.concat(own, loose)

        return _let(_own(base, i), both)

    return F.concat(*[of(i) for i in range(len(KINDS))])


class Trees:
    """Boosted trees of depth two over the integer features, with a threshold for each kind; trees of its own for each kind
    that has ``parts``, as a sign means something else in a card than in an address."""

    def __init__(self) -> None:
        self.trees: list[tuple] = []
        self.bias = 0.0
        self.parts: dict[int, Trees] = {}
        #: For each kind the least rounded margin that is selected.
        self.thresholds: dict[int, float] = {}

    def margin(self, x: tuple) -> float:
        if self.parts:
            return self.parts[x[0]].margin(x) if x[0] in self.parts else NEVER
        total = self.bias
        for (f, cut), *sides in self.trees:
            (g, below), low, high = sides[x[f] > cut]
            total += high if x[g] > below else low
        return total

    def score(self, x: Column) -> Column:
        """The margin of a proposal, as an expression."""
        if self.parts:
            total = F.lit(NEVER)
            for kind, part in self.parts.items():
                total = F.when(x["kind"] == kind, part.score(x)).otherwise(total)
            return total
        total = F.lit(self.bias)
        for (f, cut), low_side, high_side in self.trees:
            def leaf(side):
                (g, below), low, high = side
                return F.when(x[FEATURES[g]] > below, F.lit(high)).otherwise(F.lit(low))

            total = total + F.when(x[FEATURES[f]] > cut, leaf(high_side)).otherwise(leaf(low_side))
        return total

    def rounded(self, x: Column) -> Column:
        """The margin in parts of ``STEP``, 1 at least for a margin above 0."""
        return F.ceil(F.least(self.score(x) * STEP, F.lit(float(TOP)))).cast("int")

    def chosen(self, x: Column) -> Column:
        test = F.lit(False)
        for kind, threshold in self.thresholds.items():
            test = F.when(x["kind"] == kind, self.rounded(x) >= threshold).otherwise(test)
        return test


def _split(rows: list[tuple], gain_floor: float = 1e-9) -> tuple[tuple[int, int], list, list]:
    """The best cut of ``(x, gradient, hessian)`` rows."""
    best = (gain_floor, (0, 10**6))
    all_g, all_h = sum(r[1] for r in rows), sum(r[2] for r in rows)
    for f in range(len(FEATURES)):
        sums: dict[int, list[float]] = {}
        for x, g, h in rows:
            cell = sums.setdefault(x[f], [0.0, 0.0])
            cell[0] += g
            cell[1] += h
        left_g = left_h = 0.0
        for value in sorted(sums)[:-1]:
            left_g, left_h = left_g + sums[value][0], left_h + sums[value][1]
            gain = left_g**2 / (left_h + 1) + (all_g - left_g) ** 2 / (all_h - left_h + 1) - all_g**2 / (all_h + 1)
            if gain > best[0]:
                best = (gain, (f, value))
    f, cut = best[1]
    return best[1], [r for r in rows if r[0][f] <= cut], [r for r in rows if r[0][f] > cut]


def _leaf(rows: list[tuple]) -> float:
    return RATE * sum(r[1] for r in rows) / (sum(r[2] for r in rows) + 1)


def boost(cells: list[tuple[tuple, int, int]]) -> Trees:
    """Fit to ``(features, positives, negatives)``."""
    model = Trees()
    positives, negatives = sum(c[1] for c in cells), sum(c[2] for c in cells)
    model.bias = math.log((positives + 1) / (negatives + 1))
    margins = [model.bias] * len(cells)
    for _ in range(ROUNDS):
        rows = []
        for (x, pos, neg), margin in zip(cells, margins):
            p = 1 / (1 + math.exp(-max(-30.0, min(30.0, margin))))
            rows.append((x, pos - (pos + neg) * p, (pos + neg) * p * (1 - p)))
        cut, low, high = _split(rows)
        sides = []
        for side in (low, high):
            below, left, right = _split(side)
            sides.append((below, _leaf(left), _leaf(right)))
        model.trees.append((cut, *sides))
        one = Trees()
        one.trees = model.trees[-1:]
        margins = [margin + one.margin(cell[0]) for cell, margin in zip(cells, margins)]
    return model


def fit(docs: DataFrame) -> Trees:
    """Trees from the texts' own proposals and their base spans in loose form."""
    rows = docs.select(text_of().alias("t")).select("t", base_spans(F.col("t")).alias("b"))
    rows = rows.select((F.pmod(F.xxhash64("t"), F.lit(CALIBRATE)) == 0).alias("held"), F.explode(examples(F.col("t"), F.col("b"))).alias("p"))
    counts = stored(
        rows.groupBy(*[F.col(f"p.{name}") for name in FEATURES], "held")
        .agg(F.count_if("p.positive").alias("pos"), F.count_if(~F.col("p.positive")).alias("neg")),
        "pii-cells",
    )
    often = counts.filter(~F.col("held")).orderBy(F.desc(F.col("pos") + F.col("neg")), *FEATURES).limit(CELLS).collect()
    cells = [(tuple(r[name] for name in FEATURES), r.pos, r.neg) for r in often]
    model = Trees()
    for kind in range(len(KINDS)):
        own = [cell for cell in cells if cell[0][0] == kind]
        if any(positives for _, positives, _ in own):
            model.parts[kind] = boost(own)
    if not model.parts:
        return model
    model.thresholds = calibrated(model, counts.filter("held"))
    return model


def calibrated(model: Trees, counts: DataFrame) -> dict[int, float]:
    """For each kind the least rounded margin above 0 from which on ``PRECISION`` is met over all of ``counts``."""
    margins = counts.select("kind", model.rounded(F.struct(*FEATURES)).alias("margin"), "pos", "neg").filter("margin > 0")
    sums = margins.groupBy("kind", "margin").agg(F.sum("pos").alias("pos"), F.sum("neg").alias("neg")).collect()
    thresholds, seen = {}, {kind: [0, 0] for kind in range(len(KINDS))}
    for r in sorted(sums, key=lambda r: r.margin, reverse=True):
        total = seen[r.kind]
        total[0], total[1] = total[0] + r.pos, total[1] + r.neg
        if total[0] >= PRECISION * sum(total):
            thresholds[r.kind] = r.margin
    return thresholds


def with_spans(docs: DataFrame, model: Trees) -> tuple[DataFrame, str]:
    """``docs`` with one more column: a struct of the base spans and all spans, both in order."""
    text, base, into = fresh(docs, "pii_text"), fresh(docs, "pii_base"), fresh(docs, "pii")
    rows = docs.withColumn(text, text_of()).withColumn(base, base_spans(F.col(text)))
    extra = F.transform(
        F.filter(proposals(F.col(text), F.col(base)), lambda p: ~p["met"] & model.chosen(p)),
        lambda p: F.struct(p["kind"].alias("kind"), p["start"].alias("start"), p["end"].alias("end")),
    ) if model.thresholds else F.array().cast("array<struct<kind:int,start:int,end:int>>")
    found = F.struct(F.col(base).alias("base"), F.array_sort(F.concat(base, extra)).alias("all"))
    return rows.withColumn(into, found).drop(text, base), into


def redact(text: Column, spans: Column) -> Column:
    """The text with every span, or run of overlapping spans, replaced by its first kind in brackets."""
    names = F.array(*[F.lit(f"[{kind.upper()}]") for kind in KINDS])
    by_place = F.array_sort(F.transform(spans, lambda s: F.struct(s["start"].alias("start"), s["kind"].alias("kind"), s["end"].alias("end"))))

    def cut(x: Column) -> Column:
        def piece(at: Column, s: Column) -> Column:
            apart = s["start"] >= at
            return F.when(apart, F.concat(_between(x["chars"], at, s["start"]), F.get(names, s["kind"]))).otherwise("")

        pieces = scanned(x["spans"], F.lit(0), lambda at, s: F.greatest(at, s["end"]), piece, "array<string>")
        last = F.aggregate(x["spans"], F.lit(0), lambda at, s: F.greatest(at, s["end"]))
        return F.concat(F.array_join(pieces, ""), _between(x["chars"], last, F.size(x["chars"])))

    whole = _let(F.struct(characters(text).alias("chars"), by_place.alias("spans")), cut)
    return F.when(F.size(spans) == 0, text).otherwise(whole)


def redacted(docs: DataFrame) -> DataFrame:
    """``docs`` with all its columns, the text redacted; ``n_chars`` follows the text where it is a column."""
    rows, found = with_spans(docs, fit(docs))
    rows = rows.withColumn("text", F.when(F.col("text").isNotNull(), redact(text_of(), F.col(f"{found}.all"))))
    if "n_chars" in docs.columns:
        kind = docs.schema["n_chars"].dataType
        rows = rows.withColumn("n_chars", F.when(F.size(f"{found}.all") > 0, F.char_length("text").cast(kind)).otherwise(F.col("n_chars")))
    return rows.drop(found)


def _joined(spans: Column) -> Column:
    names = F.array(*[F.lit(kind) for kind in KINDS])
    return F.array_join(F.transform(spans, lambda s: F.concat_ws(":", F.get(names, s["kind"]), s["start"], s["end"])), ",")


def op3_pii(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    rows, found = with_spans(docs, fit(docs))
    base, spans = F.col(f"{found}.base"), F.col(f"{found}.all")

    def count(i: int) -> Column:
        return F.size(F.filter(base, lambda s: s["kind"] == i)).cast("long").alias(f"n_{KINDS[i]}")

    return rows.select(
        "doc_id", *map(count, range(len(KINDS))), F.sha2(_joined(base), 256).alias("base_sha256"), _joined(spans).alias("spans"),
        F.sha2(redact(text_of(), spans), 256).alias("redacted_sha256"),
    )
