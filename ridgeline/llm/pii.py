"""Personal data: candidate spans, boosted trees, calibrated thresholds.  Built-in functions only.

1. Four base patterns with their checks (see :data:`BASE`) give the spans that always stay.
2. Generators of high recall propose spans that may overlap: all base matches, those that fail
   their check too, and shapes that start at any group of digits of a run.  A base match swallows
   what stands next to it (``+1 (017) 555-7713 4111...`` has too many digits for a phone and for a card),
   and is not tried again; the proposals inside it are.
3. Each proposal has features of its format (digits, groups, separators, the kind's check) and of
   its context (what it touches on both sides, a word that announces the kind).
4. Labels come from the base: 1 for its spans, 0 for matches that fail their check and for proposals that
   cut across or lie within a span.  Others are not labelled; they are what is looked for.
   Labelled proposals are counted by features, and boosted trees are fitted to the counts.
5. Scores are calibrated, and a threshold set for each kind, on the documents that are held out.  Proposals without
   a label that pass it and their kind's check are added; where added ones overlap, the best stays.

Texts are read once; proposals are written as a small table.  Positions are code points.  Spans and their sums are kept
in arrays of a row, neighbours are compared in slices of a sorted array, so work is
linear in the text (n^1.5 at worst in its number of digit runs).
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from . import boosted_trees as B
from .shared import materialise

KINDS = ("email", "ip", "card", "phone")
EMAIL, IP, CARD, PHONE = range(4)

# The contract's patterns.  Possessive repeats and look-behinds find the same matches without going back:
# what follows a repeat is never in its class, and a match cannot start within a run whose start fails.
_LOCAL = "[A-Za-z0-9._%+-]"
BASE = {
    EMAIL: rf"(?:\G|(?<!{_LOCAL})){_LOCAL}++@[A-Za-z0-9-]++(?:\.[A-Za-z0-9-]++)++",
    IP: r"(?<![0-9])[0-9]++\.[0-9]++\.[0-9]++\.[0-9]++",
    CARD: r"[0-9](?:[\x20-]?+[0-9])++",
    PHONE: r"\+[0-9][\x20().0-9-]+[0-9]",
}
#: Every match of IP, CARD and PHONE lies within one of these.
RUN = r"[+0-9][+0-9\x20().-]*+"
#: A written-out address; its text is a proposal.
SPELLED = (rf"(?i)(?<!{_LOCAL}){_LOCAL}++\x20?[\[(]\x20?at\x20?[\])]\x20?[A-Za-z0-9-]++"
           r"(?:(?:\x20?[\[(]\x20?dot\x20?[\])]\x20?|\.)[A-Za-z0-9-]++)++")
SPELLED_MARKS = ("[at]", "(at)", "[AT]", "(AT)", "[ at ]", "( at )")
#: Shapes in a run, as (kind, what must not stand before, shape, what of it is consumed): a shape is proposed at every
#: group of digits where it starts.
SHAPES = (
    (IP, r"(?<![0-9])", r"[0-9]{1,3}(?:\.[0-9]{1,3}){3}", "[0-9]++"),
    (CARD, r"(?<![0-9])", r"[0-9]{13,19}", "[0-9]++"),
    (CARD, r"(?<![0-9])", r"[0-9]{4}(?:[\x20-][0-9]{4}){3}", "[0-9]++"),
    (CARD, r"(?<![0-9])", r"[0-9]{4}[\x20-][0-9]{6}[\x20-][0-9]{4,5}", "[0-9]++"),
    (PHONE, "", r"\+[0-9]{10,15}", r"\+[0-9]++"),
    *[(PHONE, "", rf"\+[0-9]{{1,3}}(?:[\x20().-]{{1,2}}[0-9]{{2,8}}){{{n}}}", r"\+[0-9]++") for n in (1, 2, 3, 4)],
    (PHONE, r"(?<![0-9+])", r"[0-9]{3}\)?[\x20.-][0-9]{3}[\x20.-][0-9]{4}", "[0-9]++"),
)
#: What follows a span, up to two characters.
NEXT = r"((?s:.{0,2}))"
#: Fewer digits make no span of any kind; shorter failed matches are no proposals.
RUN_DIGITS, FAILED_DIGITS = 4, 7
WORDS = (r"(?i)(?:mail|contact)\W*$", r"(?i)(?:ip|host|server|address|addr)\W*$",
         r"(?i)(?:card|visa|mastercard|amex|credit|account)\W*$", r"(?i)(?:phone|tel|call|fax|mobile|cell)\W*$")
FEATURES = ("digits", "groups", "longest", "checked", "before", "after", "marks", "plus", "word")
#: Largest value of each; cells are bounded by the product.
LIMITS = (20, 8, 19, 1, 2, 2, 3, 1, 1)
#: Overlapping proposals stand within so many places of each other when sorted by start: a span of 19 digits
#: meets at most 19 groups on each side, and a group starts few shapes.
NEAR = 96
HELD_OUT, PRECISION = 5, 0.95
BLOCK = 256

_SPAN = "kind int, start int, end int"
_CANDIDATE = _SPAN + ", base boolean, label int, " + ", ".join(f"{f} int" for f in FEATURES)


def let(value: Column, body: Callable[[Column], Column]) -> Column:
    """``body`` of a value that is computed once."""
    return F.transform(F.array(value), body)[0]


def upto(lengths: Column) -> Column:
    """For each element the sum of those before it, by blocks of ``BLOCK``."""
    total = lambda part: F.aggregate(part, F.lit(0), lambda a, x: a + x)
    block = lambda i: (i / BLOCK).cast("int")

    def sums(all_):
        blocks = F.transform(F.sequence(F.lit(0), block(F.size(all_))), lambda b: total(F.slice(all_, b * BLOCK + 1, BLOCK)))
        return let(blocks, lambda each: let(
            F.transform(each, lambda _, b: total(F.slice(each, F.lit(1), b))), lambda first: F.transform(
                all_, lambda _, i: first[block(i)] + total(F.slice(all_, block(i) * BLOCK + 1, i % BLOCK)))))
    return let(lengths, sums)


def found(text: Column, pattern: str, group: int = 0) -> Column:
    """Matches of ``pattern`` in order, as arrays: all, of (the given group, which starts where the match does), next (the
    group after it, what follows) and rest, the text between them."""
    group_of = lambda n: F.regexp_extract_all(text, F.lit(pattern), F.lit(n))
    return F.struct(group_of(0).alias("all"), group_of(group).alias("of"), group_of(group + 1).alias("next"),
                    F.split(text, pattern, -1).alias("rest"))


def placed(m: Column) -> Column:
    """Array of (start, text, left, right) of what :func:`found` gives: left is what stands before, 24 characters at most."""
    return let(
        upto(F.transform(m["all"], lambda x, i: F.char_length(x) + F.char_length(m["rest"][i]))),
        lambda at: F.transform(m["of"], lambda x, i: F.struct(
            (at[i] + F.char_length(m["rest"][i])).alias("start"), x.alias("text"),
            F.substring(F.concat(F.coalesce(F.get(m["all"], i - 1), F.lit("")), m["rest"][i]), -24, 24).alias("left"),
            m["next"][i].alias("right"))))


def matches(text: Column, pattern: str) -> Column:
    """Array of (start, text, left, right), one for each match of ``pattern``."""
    return let(found(text, pattern), placed)


def digits(text: Column) -> Column:
    return F.regexp_replace(text, "[^0-9]", "")


def luhn(number: Column) -> Column:
    """Whether a string of digits passes the check sum."""
    def add(total, i):
        return let(F.substring(number, -i, F.lit(1)).cast("int"), lambda x: total + F.when(
            i % 2 == 0, x * 2 - F.when(x > 4, 9).otherwise(0)).otherwise(x))
    return F.aggregate(F.sequence(F.lit(1), F.char_length(number)), F.lit(0), add) % 10 == 0


_PART = "0*(?:[0-9]{1,2}|1[0-9]{2}|2[0-4][0-9]|25[0-5])"


def checked(kind: Column, text: Column) -> Column:
    """The check of each kind on a span's text."""
    n = lambda d: F.char_length(d)
    return (F.when(kind == EMAIL, text.rlike(r"(?i)(?:\.|dot\x20?[\])]\x20?)[a-z]{2,24}$"))
            .when(kind == IP, text.rlike(rf"^{_PART}(?:\.{_PART}){{3}}$"))
            .when(kind == CARD, let(digits(text), lambda d: F.when(n(d).between(14, 19), luhn(d)).otherwise(False)))
            .otherwise(let(digits(text), lambda d: n(d).between(10, 15))))


def _features(kind: Column, text: Column, left: Column, right: Column, holds: Column) -> list[Column]:
    """Format and context as small integers; ``left`` and ``right`` are the characters around the span."""
    number = F.when(kind == EMAIL, F.regexp_replace(text, r"(?i)(?:@|\x20?[\[(]\x20?at).*", "")).otherwise(digits(text))
    groups = F.when(kind == EMAIL, F.regexp_extract_all(text, F.lit(r"(?i)\.|dot\x20?[\])]"), F.lit(0))).otherwise(
        F.regexp_extract_all(text, F.lit("[0-9]+"), F.lit(0)))
    marks = F.array_distinct(F.regexp_extract_all(text, F.lit(r"[\x20().-]"), F.lit(0)))
    side = lambda glued, going_on: F.when(going_on, 2).when(glued, 1).otherwise(0)
    flag = lambda c: F.when(c, 1).otherwise(0)
    word = F.lit(False)
    for k, pattern in enumerate(WORDS):
        word = word | ((kind == k) & left.rlike(pattern))
    values = [F.char_length(number), F.size(groups),
              F.aggregate(groups, F.lit(0), lambda a, g: F.greatest(a, F.char_length(g))),
              flag(holds),
              side(left.rlike(r"[\p{L}\p{N}_@%=/]$"), (kind != EMAIL) & left.rlike(r"[0-9][\x20.-]?$")),
              side(right.rlike(r"^[\p{L}\p{N}_@%=/]"), (kind != EMAIL) & right.rlike(r"^[\x20.-]?[0-9]")),
              F.when(kind == EMAIL, 0).otherwise(F.size(marks)), flag(F.startswith(text, F.lit("+"))), flag(word)]
    return [F.least(v, F.lit(limit)).cast("int").alias(name) for v, limit, name in zip(values, LIMITS, FEATURES, strict=True)]


_RAW = "struct<kind:int,start:int,text:string,left:string,right:string,matched:boolean>"


def _raw(kind: Column, start: Column, text: Column, left: Column, right: Column, matched: Column) -> Column:
    """A span to be proposed; ``matched``: it is a match of its kind's base pattern, and stays if the check holds."""
    return F.struct(kind.cast("int").alias("kind"), start.cast("int").alias("start"), text.alias("text"), left.alias("left"),
                    right.alias("right"), matched.alias("matched"))


def _candidate(s: Column) -> Column:
    """The proposal of a span.  It stands once in the plan: building its many expressions takes time."""
    def made(holds):
        known = s["matched"] & ((s["kind"] == EMAIL) | holds)
        return F.struct(s["kind"].alias("kind"), s["start"].alias("start"), (s["start"] + F.char_length(s["text"])).cast("int").alias("end"),
                        known.alias("base"), F.when(known, 1).when(s["matched"], 0).cast("int").alias("label"),
                        *_features(s["kind"], s["text"], s["left"], s["right"], holds))
    return let(checked(s["kind"], s["text"]), made)


def _in_run(run: Column) -> Column:
    """The spans to be proposed in one run of digits and marks."""
    def spans_of(kind, pattern, shape):
        return F.struct(F.lit(kind).alias("kind"), F.lit(shape).alias("shape"), found(run["text"], pattern, shape).alias("m"))
    lists = [spans_of(kind, f"{BASE[kind]}(?={NEXT})", 0) for kind in (IP, CARD, PHONE)]
    for kind, before, shape, consumed in SHAPES:
        pattern = f"{before}(?=({shape})(?![0-9]){NEXT}){consumed}"
        lists.append(F.when(run["text"].rlike(pattern), spans_of(kind, pattern, 1)))
    spans = F.flatten(F.transform(F.filter(F.array(*lists), lambda of: of.isNotNull()), lambda of: F.transform(
        placed(of["m"]), lambda m: F.struct(of["kind"].alias("kind"), m["start"].alias("start"), m["text"].alias("text"),
                                            of["shape"].alias("shape"), m["left"].alias("left"), m["right"].alias("right")))))

    def around(s):
        left = F.when(s["start"] < 24, F.concat(run["left"], F.substring(run["text"], F.lit(1), s["start"]))).otherwise(s["left"])
        return _raw(s["kind"], run["start"] + s["start"], s["text"], left, F.concat(s["right"], run["right"]), s["shape"] == 0)
    return let(F.sort_array(spans), lambda ordered: F.transform(_distinct(ordered), around))


def _distinct(spans: Column) -> Column:
    """Sorted (kind, start, text, shape, ...) without repeated spans (a base match comes first) and short digit groups."""
    def new(s, p):
        return p.isNull() | (p["kind"] != s["kind"]) | (p["start"] != s["start"]) | (p["text"] != s["text"])
    enough = lambda s: F.char_length(digits(s["text"])) >= F.when(s["kind"] == IP, RUN_DIGITS).otherwise(FAILED_DIGITS)
    return F.filter(spans, lambda s, i: new(s, F.get(spans, i - 1)) & enough(s))


def candidates(text: Column) -> Column:
    """All proposals of a text, sorted by start: array of :data:`_CANDIDATE`."""
    numeric = F.transform(F.filter(matches(text, f"{RUN}(?={NEXT})"), lambda r: F.char_length(digits(r["text"])) >= RUN_DIGITS), _in_run)
    email = F.transform(matches(text, f"{BASE[EMAIL]}(?={NEXT})"), lambda m: F.array(
        _raw(F.lit(EMAIL), m["start"], m["text"], m["left"], m["right"], F.lit(True)),
        # the same address without its last label
        _raw(F.lit(EMAIL), m["start"], F.regexp_replace(m["text"], r"\.[^.]*$", ""), m["left"], F.lit("."), F.lit(False))))
    spelled = F.transform(matches(text, f"{SPELLED}(?={NEXT})"), lambda m: F.array(
        _raw(F.lit(EMAIL), m["start"], m["text"], m["left"], m["right"], F.lit(False))))
    none = F.array().cast(f"array<array<{_RAW}>>")
    marked = F.lit(False)
    for mark in SPELLED_MARKS:
        marked = marked | F.contains(text, F.lit(mark))
    spans = F.flatten(F.concat(F.when(text.rlike("[0-9]"), numeric).otherwise(none), F.when(F.contains(text, F.lit("@")), email).otherwise(none),
                               F.when(marked, spelled).otherwise(none)))
    by_start = F.array_sort(F.transform(spans, _candidate), lambda a, b: F.when(a["start"] != b["start"], a["start"] - b["start"])
                            .when(a["kind"] != b["kind"], a["kind"] - b["kind"]).otherwise(a["end"] - b["end"]))

    def labelled(c, i, everyone):
        near = F.slice(everyone, F.greatest(i - NEAR, F.lit(0)) + 1, 2 * NEAR)
        within = F.exists(near, lambda o: o["base"] & (o["start"] < c["end"]) & (c["start"] < o["end"]))
        return c.withField("label", F.when(c["label"].isNotNull(), c["label"]).when(within, 0))
    return let(by_start, lambda everyone: F.transform(everyone, lambda c, i: labelled(c, i, everyone)))


class Detector:
    """Trees, calibration and threshold of each kind."""

    def __init__(self, cells: dict[int, list[B.Cell]], held_out: dict[int, list[B.Cell]]):
        self.models, self.cuts, self.slopes = {}, {}, {}
        for kind in range(len(KINDS)):
            model = B.fit(cells.get(kind, []))
            scored = [(model.score(c.values), c.ones, c.zeros) for c in sorted(held_out.get(kind, []), key=lambda c: c.values)]
            self.models[kind], self.slopes[kind] = model, B.calibrate(scored) if scored else (1.0, 0.0)
            self.cuts[kind] = B.threshold(scored, PRECISION)

    def score(self, c: Column) -> Column:
        """Calibrated log odds above the kind's threshold; null where no threshold is safe."""
        out = F.lit(None).cast("double")
        for kind, model in self.models.items():
            if self.cuts[kind] is not None:
                a, _ = self.slopes[kind]
                over = model.expr(lambda f: c[FEATURES[f]]) - F.lit(self.cuts[kind])  # noqa: B023
                out = F.when(c["kind"] == kind, F.lit(a) * over).otherwise(out)
        return out

    def probability(self, kind: int, values) -> float:
        a, b = self.slopes[kind]
        return B.sigmoid(a * self.models[kind].score(values) + b)


def learn(proposals: DataFrame) -> Detector:
    """Trees and thresholds from the labelled proposals of (doc_id, found); counts by features are all that is collected."""
    rows = proposals.select(F.coalesce(F.crc32(F.col("doc_id").cast("string")) % HELD_OUT == 0, F.lit(False)).alias("held"),
                            F.explode("found").alias("c")).where("c.label is not null")
    counts = (rows.groupBy("held", "c.kind", *[F.col(f"c.{f}") for f in FEATURES])
              .agg(F.sum(F.col("c.label")).alias("ones"), F.count(F.lit(1)).alias("n")).collect())
    cells: tuple[dict, dict] = ({}, {})
    for r in counts:
        cells[r["held"]].setdefault(r["kind"], []).append(B.Cell(tuple(r[f] for f in FEATURES), r["ones"], r["n"] - r["ones"]))
    return Detector(*cells)


def _selected(found: Column, detector: Detector) -> Column:
    """(start, kind, end) of the base spans and of the proposals that are added, in this order."""
    span = lambda c: F.struct(c["start"].alias("start"), c["kind"].alias("kind"), c["end"].alias("end"))
    scored = F.transform(F.filter(found, lambda c: c["label"].isNull() & (c["checked"] == 1)), lambda c: F.struct(
        span(c).alias("span"), detector.score(c).alias("over")))

    def stays(c, i, everyone):
        near = F.slice(everyone, F.greatest(i - NEAR, F.lit(0)) + 1, 2 * NEAR)
        rank = lambda x: F.struct(x["over"], x["span"]["end"] - x["span"]["start"], -x["span"]["start"], -x["span"]["kind"])
        return ~F.exists(near, lambda o: (o["span"]["start"] < c["span"]["end"]) & (c["span"]["start"] < o["span"]["end"])
                         & (rank(o) > rank(c)))
    added = let(F.filter(scored, lambda c: c["over"] >= 0), lambda everyone: F.transform(
        F.filter(everyone, lambda c, i: stays(c, i, everyone)), lambda c: c["span"]))
    return F.sort_array(F.concat(F.transform(F.filter(found, lambda c: c["base"]), span), added))


def _listed(spans: Column) -> Column:
    names = F.array(*[F.lit(k) for k in KINDS])
    return F.array_join(F.transform(spans, lambda s: F.concat(names[s["kind"]], F.lit(":"), s["start"].cast("string"), F.lit(":"),
                                                              s["end"].cast("string"))), ",")


def proposals(docs: DataFrame) -> DataFrame:
    """(doc_id, found) for each row of ``docs``, written once."""
    text = F.coalesce(F.col("text").cast("string"), F.lit(""))
    return materialise(docs.select("doc_id", let(text, candidates).alias("found")), "pii-proposals")


def find_spans(docs: DataFrame, detector: Detector | None = None) -> DataFrame:
    """doc_id, spans and base: arrays of (start, kind, end), for each row of ``docs`` (doc_id, text, ...).

    A null or empty text has no spans.  Ids may be null or repeat, each row is a text of its own (a null id
    is not held out); other columns are ignored; an empty table gives an empty result.  Without ``detector`` one is learned from
    all rows; a kind with too few held-out spans for a threshold of 95 % precision adds nothing.
    """
    rows = proposals(docs)
    detector = detector or learn(rows)
    base = F.sort_array(F.transform(F.filter("found", lambda c: c["base"]), lambda c: F.struct(
        c["start"].alias("start"), c["kind"].alias("kind"), c["end"].alias("end"))))
    return rows.select("doc_id", base.alias("base"), _selected(F.col("found"), detector).alias("spans"))


def redact(docs: DataFrame, detector: Detector | None = None) -> DataFrame:
    """doc_id and text with each span (overlapping ones as one) replaced by its kind in brackets."""
    text = F.coalesce(F.col("text").cast("string"), F.lit(""))
    found = proposals(docs.select("doc_id", "text"))
    detector = detector or learn(found)
    both = docs.select("doc_id", text.alias("text"), let(text, candidates).alias("found"))

    def cut(t, spans):
        def step(acc, s):
            here = F.greatest(s["start"], acc["at"])
            piece = F.substring(t, acc["at"] + 1, here - acc["at"])
            name = F.concat(F.lit("["), F.array(*[F.lit(k.upper()) for k in KINDS])[s["kind"]], F.lit("]"))
            return F.when(s["start"] < acc["at"], F.struct(F.greatest(acc["at"], s["end"]).alias("at"), acc["out"].alias("out"))).otherwise(
                F.struct(s["end"].alias("at"), F.array_append(F.array_append(acc["out"], piece), name).alias("out")))
        start = F.struct(F.lit(0).alias("at"), F.array().cast("array<string>").alias("out"))
        return F.aggregate(spans, start, step, lambda acc: F.concat(F.array_join(acc["out"], ""), F.substring(
            t, acc["at"] + 1, F.char_length(t))))
    return both.select("doc_id", let(F.struct(F.col("text"), _selected(F.col("found"), detector).alias("spans")),
                                     lambda x: cut(x["text"], x["spans"])).alias("text"))


def digest(docs: DataFrame) -> DataFrame:
    """doc_id, counts of the base spans by kind, digest of the base and the list of all spans."""
    rows = find_spans(docs)
    count = lambda k: F.size(F.filter("base", lambda s: s["kind"] == k)).cast("long").alias(f"n_{KINDS[k]}")
    return rows.select("doc_id", *[count(k) for k in range(len(KINDS))], F.sha2(_listed(F.col("base")), 256).alias("base_sha256"),
                       _listed(F.col("spans")).alias("spans"))
