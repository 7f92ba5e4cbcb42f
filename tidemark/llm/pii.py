"""Personal data by weak supervision, with DataFrame functions only.

Base spans are emails, IP addresses, card numbers and phone numbers that match a pattern
and pass its check. Candidates for more are what no base span touches: matches that failed
the check, other ways to write such data, and look-alikes (an unclosed disguise, numbers of
three parts, plain runs of digits). Four labelers vote for or against a span or abstain: the
pattern's check, a gazetteer (domains, issuers, address ranges, area codes), the words before
it, and its edges. The votes of all documents are counted; expectation maximisation over the
counts estimates how reliable each labeler is for each kind, where base spans are known to be
personal data and candidates are not known; to abstain is no evidence. A logistic classifier
of votes and shape is trained on the probabilities of the candidates alone. Those that it is
sure of are added to the base spans, which always stay.

A null text is an empty one and has no spans. Positions count code points, the end is
exclusive. Spans of one kind don't overlap. Without candidates nothing is added. Columns
of the input other than the text are passed on; those named like the result are replaced.
"""

from __future__ import annotations

import math
from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

KINDS = ("email", "ip", "card", "phone")
SPANS = "array<struct<start:int,end:int,value:string,before:string,behind:string>>"
BLOCK = 64

# The patterns take whole runs of characters at once (possessive), and begin where a run
# begins or the last match ended, so that long runs take linear time.
_LOCAL = "A-Za-z0-9._%+-"
BASE = {
    "email": rf"(?:\G|(?<![{_LOCAL}]))[{_LOCAL}]++@[A-Za-z0-9-]++(?:\.[A-Za-z0-9-]++)++",
    "ip": r"(?<![0-9])[0-9]++\.[0-9]++\.[0-9]++\.[0-9]++",
    "card": r"[0-9](?:[\x20-]?[0-9])++",
    "phone": r"\+[0-9][\x20().0-9-]+[0-9]",
}
_AT, _DOT = r"\x20?[\[(]at[\])]\x20?", r"\x20?[\[(]dot[\])]\x20?"
WIDER = {
    "email": rf"(?<![{_LOCAL}])[{_LOCAL}]++{_AT}[A-Za-z0-9-]++(?:(?:{_DOT}|\.)[A-Za-z0-9-]++)++",
    "ip": r"(?<![0-9A-Fa-f:])(?:[0-9A-Fa-f]{1,4}:){7}[0-9A-Fa-f]{1,4}(?![0-9A-Fa-f:])",
    "phone": r"(?<![0-9A-Za-z])(?:\([0-9]{3}\)\x20?|[0-9]{3}[.\x20-])[0-9]{3}[.\x20-][0-9]{4}(?![0-9A-Za-z])",
}
# Look-alikes, which the check speaks against.
ALIKE = {
    "email": rf"(?<![{_LOCAL}])[{_LOCAL}]++{_AT}[A-Za-z0-9-]++(?!(?:{_DOT}|\.)[A-Za-z0-9-])",
    "ip": r"(?<![0-9.])[0-9]{1,3}+\.[0-9]{1,3}+\.[0-9]{1,3}+(?!\.?[0-9])",
    "phone": r"(?<![0-9A-Za-z+])(?<![0-9][.-])[0-9]{9,11}+(?![0-9A-Za-z]|[.-][0-9])",
}
_OCTET = "0*(?:25[0-5]|2[0-4][0-9]|1?[0-9]{1,2})"
_SEPARATORS = "+ ().-"

# Gazetteers and words of context, lower case.
DOMAINS = r"\.\s?(?:com|org|net|edu|gov|io|info|de|fr|es|uk|eu|ch|at|it|nl)$"
AREAS = r"^(?:\+(?:[0-9]{1,3}[^0-9]+)?)?[^0-9+]*[2-9]"
ISSUERS = r"^(?:3[4-7]|4|5[1-5]|2[2-7]|6)"
PUBLIC = r"^0*(?:[1-9]|[1-9][0-9]|1[0-9][0-9]|2[01][0-9]|22[0-3])(?:\.[0-9]+){3}$"
CONTEXT = {
    "email": r"\b(?:e-?mail|mail|contact|write|address|correo|courriel|kontakt)\b",
    "ip": r"\b(?:ip|ipv6|host|server|client|login|address|adresse)\b",
    "card": r"\b(?:card|visa|mastercard|amex|credit|payment|karte|carte|tarjeta)\b",
    "phone": r"\b(?:phone|tel|telephone|call|fax|mobile|cell|telefon|telefono|appel)\b",
}
AGAINST = r"\b(?:version|ver|order|invoice|isbn|issn|sha|md5|hash|token|key|password|id)\b|[=\"#]\s?$"
BEFORE = 32

# Added spans have at least this probability.
SURE = 0.9
VOTES = ("check", "gazetteer", "context", "edges")
SHAPES = ("separated", "long", "spaced")


def _located(text: Column, pattern: str) -> Column:
    """The matches of a pattern with their places and what is next to them.

    Between and around n matches are n + 1 other parts; a match begins behind all parts
    and matches before it. Places are summed up inside blocks of matches and then over
    the blocks, as appending to one long array would take quadratic time.
    """
    both = F.struct(
        F.regexp_extract_all(text, F.lit(pattern), F.lit(0)).alias("found"), F.split(text, pattern, -1).alias("parts")
    )
    return _let(both, lambda m: _placed(m["found"], m["parts"]))


def _let(value: Column, body: Callable[[Column], Column]) -> Column:
    """The body with a value that is computed once, not wherever the body uses it."""
    return F.element_at(F.transform(F.array(value), body), 1)


def _placed(found: Column, parts: Column) -> Column:
    around = F.zip_with(
        F.slice(parts, F.lit(1), F.size(found)),
        F.slice(parts, F.lit(2), F.size(found)),
        lambda part, following: F.struct(
            F.char_length(part).alias("gap"),
            F.right(part, F.lit(BEFORE)).alias("before"),
            F.left(following, F.lit(1)).alias("behind"),
        ),
    )
    steps = F.zip_with(around, found, lambda own, value: F.struct(own.alias("own"), value.alias("value")))

    def add(state, step):
        start = state["at"] + step["own"]["gap"]
        end = start + F.char_length(step["value"])
        own = F.struct(
            start.alias("start"),
            end.alias("end"),
            step["value"].alias("value"),
            step["own"]["before"].alias("before"),
            step["own"]["behind"].alias("behind"),
        )
        return F.struct(end.alias("at"), F.concat(state["spans"], F.array(own)).alias("spans"))

    begin = F.struct(F.lit(0).alias("at"), F.array().cast(SPANS).alias("spans"))
    inside = F.transform(_blocks(steps), lambda block: F.aggregate(block, begin, add))

    def shift(state, block):
        own = F.struct(state["at"].alias("shift"), block["spans"].alias("spans"))
        return F.struct((state["at"] + block["at"]).alias("at"), F.concat(state["out"], F.array(own)).alias("out"))

    none = F.array().cast(f"array<struct<shift:int,spans:{SPANS}>>")
    shifted = F.aggregate(
        inside, F.struct(F.lit(0).alias("at"), none.alias("out")), shift, lambda state: state["out"]
    )
    return F.flatten(F.transform(shifted, _moved))


def _blocks(values: Column) -> Column:
    """An array cut into arrays of at most BLOCK elements."""

    def cut(own):
        count = F.ceil(F.size(own) / F.lit(BLOCK)).cast("int")
        numbers = F.when(count > 0, F.sequence(F.lit(0), count - 1)).otherwise(F.array().cast("array<int>"))
        return F.transform(numbers, lambda n: F.slice(own, n * BLOCK + 1, F.lit(BLOCK)))

    return _let(values, cut)


def _moved(block: Column) -> Column:
    return F.transform(
        block["spans"],
        lambda s: F.struct(
            (s["start"] + block["shift"]).alias("start"),
            (s["end"] + block["shift"]).alias("end"),
            s["value"].alias("value"),
            s["before"].alias("before"),
            s["behind"].alias("behind"),
        ),
    )


def _checked(kind: str, value: Column) -> Column:
    """Whether a match of the base pattern is one."""
    if kind == "ip":
        return value.rlike(rf"^{_OCTET}(?:\.{_OCTET}){{3}}$")
    if kind == "card":
        digits = F.translate(value, " -", "")
        return F.length(digits).between(12, 19) & F.call_function("luhn_check", digits)
    if kind == "phone":
        return F.length(F.translate(value, _SEPARATORS, "")).between(9, 15)
    return F.lit(True)


def _gazetteer(kind: str, value: Column) -> Column:
    lower = F.lower(value)
    if kind == "email":
        return F.regexp_replace(lower, r"\s?[\[(]dot[\])]\s?", ".").rlike(DOMAINS)
    if kind == "ip":
        return lower.rlike(PUBLIC) | lower.contains(":")
    if kind == "card":
        return F.translate(value, " -", "").rlike(ISSUERS)
    return value.rlike(AREAS)


def _possible(text: Column, kind: str, wider: bool) -> Column:
    """A cheap test that texts without such data fail."""
    if kind == "email":
        return text.contains("@") if not wider else text.rlike(r"[\[(]at[\])]")
    if kind == "phone" and not wider:
        return text.contains("+")
    if kind == "ip" and wider:
        return text.contains(":")
    return text.rlike("[0-9]")


def candidates(text: Column) -> Column:
    """Base spans, and the other matches that none of them touches, with votes and shape."""
    arrays = []
    for kind in KINDS:
        base = F.when(_possible(text, kind, False), _located(text, BASE[kind])).otherwise(F.array().cast(SPANS))
        if kind == "card":
            # Shorter runs of digits are numbers of any sort.
            base = F.filter(base, lambda s: F.length(F.translate(s["value"], " -", "")).between(12, 19))
        arrays.append(F.transform(base, _description(kind, None)))
        for patterns, check in ((WIDER, 0), (ALIKE, -1)):
            if kind in patterns:
                # Numbers of three parts have no colon, unlike the wider form of an address.
                possible = F.lit(True) if (kind, check) == ("ip", -1) else _possible(text, kind, True)
                more = F.when(possible, _located(text, patterns[kind])).otherwise(F.array().cast(SPANS))
                arrays.append(F.transform(more, _description(kind, check)))
    return _let(F.concat(*arrays), _uncovered)


def _uncovered(found: Column) -> Column:
    """Without candidates that share a character with a base span."""

    def free(base: Column) -> Column:
        touches = lambda s: F.exists(base, lambda b: (b["start"] < s["end"]) & (s["start"] < b["end"]))
        return F.filter(found, lambda s: s["base"] | ~touches(s))

    return _let(F.filter(found, lambda s: s["base"]), free)


def _description(kind: str, check: int | None) -> Callable[[Column], Column]:
    return lambda span: _described(span, kind, check)


def _described(span: Column, kind: str, check: int | None) -> Column:
    """Votes and shape; ``check`` is a fixed vote of the check, which else reads the value."""
    value, before, behind = span["value"], F.lower(span["before"]), span["behind"]
    vote = lambda yes, no: F.when(yes, 1).when(no, -1).otherwise(0)
    passes = F.lit(False) if check is not None else _checked(kind, value)
    checked = F.lit(check) if check is not None else vote(passes, ~passes)
    known = _gazetteer(kind, value)
    cramped = before.rlike(r"[\p{L}\p{N}_]$") | behind.rlike(r"^[\p{L}\p{N}_]")
    return F.struct(
        span["start"].alias("start"),
        F.lit(KINDS.index(kind)).alias("kind"),
        span["end"].alias("end"),
        passes.alias("base"),
        checked.alias("check"),
        vote(known, ~known).alias("gazetteer"),
        vote(before.rlike(CONTEXT[kind]), before.rlike(AGAINST)).alias("context"),
        vote(~cramped, cramped).alias("edges"),
        value.rlike(r"[\s().-]").cast("int").alias("separated"),
        (F.char_length(value) > 20).cast("int").alias("long"),
        (before.rlike(r"(?:^|\s)$") & behind.rlike(r"^(?:$|[\s.,;])")).cast("int").alias("spaced"),
    )


@dataclass
class SpanModel:
    """Reliabilities of the labelers and the classifier's coefficients, by kind."""

    # P(vote | class): by kind and labeler, for class 0 and 1, of the votes -1, 0 and 1.
    reliability: dict[int, dict[str, list[list[float]]]]
    coefficients: dict[int, list[float]]


def _inputs(row: dict) -> list[float]:
    """Votes as they are, and the shape."""
    return [1.0, *(float(row[v]) for v in VOTES), *(float(row[s]) for s in SHAPES)]


def fit(docs: DataFrame, text: str = "text", rounds: int = 30) -> SpanModel:
    """Estimate over the votes on all spans of all documents, train on the candidates' part.

    The counts by kind, base, votes and shape have at most 2 * 4 * 3**4 * 2**3 rows. A kind
    without candidates has no classifier.
    """
    found = docs.select(F.explode(candidates(F.coalesce(F.col(text), F.lit("")))).alias("c")).select("c.*")
    by = ("kind", "base", *VOTES, *SHAPES)
    counted = found.groupBy(*by).count().orderBy(*by).collect()
    rows = [r.asDict() for r in counted]
    reliability, coefficients = {}, {}
    for kind in range(len(KINDS)):
        own = [r for r in rows if r["kind"] == kind]
        if own:
            reliability[kind], belief = estimate(own, rounds)
            open_ = [(r, b) for r, b in zip(own, belief, strict=True) if not r["base"]]
            if open_:
                rows_, beliefs = zip(*open_, strict=True)
                coefficients[kind] = train([_inputs(r) for r in rows_], beliefs, [r["count"] for r in rows_])
    return SpanModel(reliability, coefficients)


def estimate(rows: list[dict], rounds: int = 30, prior: float = 10.0) -> tuple[dict, list[float]]:
    """Reliabilities by expectation maximisation, and the probability of each row's class 1.

    Rows with ``base`` set are known to be of class 1 and have no part in its share among the
    others. A labeler abstains equally often in both classes. The prior counts say that a
    labeler is right more often than wrong; they keep the classes from changing places.
    """
    # Votes -1, 0 and 1 of class 0 and of class 1.
    start = [[0.5, 0.3, 0.2], [0.2, 0.3, 0.5]]
    table = {v: [list(p) for p in start] for v in VOTES}
    known = [bool(row.get("base")) for row in rows]
    total = sum(r["count"] for r in rows)
    unknown = sum(r["count"] for r, k in zip(rows, known, strict=True) if not k)
    share = 0.5
    belief = [1.0] * len(rows)
    for _ in range(rounds):
        for i, row in enumerate(rows):
            if known[i]:
                continue
            odds = math.log(share / (1 - share))
            for v in VOTES:
                odds += math.log(table[v][1][row[v] + 1] / table[v][0][row[v] + 1])
            belief[i] = 1 / (1 + math.exp(-max(-500.0, min(500.0, odds))))
        positive = sum(r["count"] * b for r, b, k in zip(rows, belief, known, strict=True) if not k)
        share = (positive + prior / 2) / (unknown + prior)
        for v in VOTES:
            abstained = sum(r["count"] for r in rows if r[v] == 0)
            silent = (abstained + prior * start[0][1]) / (total + prior)
            for c in (0, 1):
                sums = [prior * p for p in start[c]]
                for row, b in zip(rows, belief, strict=True):
                    sums[row[v] + 1] += row["count"] * (b if c else 1 - b)
                voted = sums[0] + sums[2]
                table[v][c] = [(1 - silent) * sums[0] / voted, silent, (1 - silent) * sums[2] / voted]
    return table, belief


def train(inputs: list[list[float]], belief: list[float], counts: list[int], steps: int = 400) -> list[float]:
    """A logistic regression on probabilities, by gradient ascent with momentum."""
    total = float(sum(counts))
    beta, speed = [0.0] * len(inputs[0]), [0.0] * len(inputs[0])
    for _ in range(steps):
        gradient = [-0.001 * b for b in beta]
        for x, y, n in zip(inputs, belief, counts, strict=True):
            margin = max(-500.0, min(500.0, sum(a * b for a, b in zip(x, beta, strict=True))))
            error = (y - 1 / (1 + math.exp(-margin))) * n / total
            for j, value in enumerate(x):
                gradient[j] += error * value
        speed = [0.9 * s + 0.3 * g for s, g in zip(speed, gradient, strict=True)]
        beta = [b + s for b, s in zip(beta, speed, strict=True)]
    return beta


def _probability(model: SpanModel, found: Column) -> Column:
    """The classifier's probability of a candidate."""
    chosen = F.lit(0.0)
    for kind, beta in model.coefficients.items():
        margin = F.lit(beta[0])
        for name, b in zip((*VOTES, *SHAPES), beta[1:], strict=True):
            margin = margin + found[name] * F.lit(b)
        chosen = F.when(found["kind"] == kind, 1 / (1 + F.exp(-margin))).otherwise(chosen)
    return chosen


def find(docs: DataFrame, model: SpanModel, text: str = "text", sure: float = SURE) -> DataFrame:
    """Add the arrays base_spans and all_spans: (start, kind, end), by start and kind."""
    content = F.coalesce(F.col(text), F.lit(""))
    with_all = docs.drop("base_spans", "all_spans").withColumn("_found", candidates(content))
    brief = lambda s: F.struct(s["start"].alias("start"), s["kind"].alias("kind"), s["end"].alias("end"))
    base = F.array_sort(F.transform(F.filter("_found", lambda s: s["base"]), brief))
    with_base = with_all.withColumn("base_spans", base)
    added = F.filter("_found", lambda s: ~s["base"] & (_probability(model, s) >= sure))
    everything = F.array_sort(F.concat("base_spans", _apart(F.transform(added, brief))))
    return with_base.withColumn("all_spans", everything).drop("_found")


def _apart(spans: Column) -> Column:
    """Of added spans that overlap the first by start and kind."""
    empty = F.array().cast("array<struct<start:int,kind:int,end:int>>")
    add = lambda kept, s: F.when(
        F.exists(kept, lambda k: (k["start"] < s["end"]) & (s["start"] < k["end"])), kept
    ).otherwise(F.concat(kept, F.array(s)))
    return F.aggregate(F.array_sort(spans), empty, add)


def written(spans: Column) -> Column:
    """kind:start:end, joined by commas."""
    names = F.array(*[F.lit(k) for k in KINDS])
    one = lambda s: F.concat_ws(
        ":", F.element_at(names, s["kind"] + 1), s["start"].cast("string"), s["end"].cast("string")
    )
    return F.array_join(F.transform(spans, one), ",")


def masked(text: Column, spans: Column) -> Column:
    """The text with each span replaced by its kind in brackets; overlapping spans merge.

    Spans come in blocks; each block's stretch of text is cut out once, and its spans are
    replaced in that.
    """
    names = F.array(*[F.lit(f"[{k.upper()}]") for k in KINDS])
    end_of = lambda own: F.aggregate(own, F.lit(0), lambda most, s: F.greatest(most, s["end"]))

    def stretch(state, block):
        # From the end of all spans before to the end of this block's.
        def until(end):
            cut = F.substring(text, state["at"] + 1, end - state["at"])
            own = F.struct(state["at"].alias("from"), cut.alias("text"), block.alias("spans"))
            return F.struct(end.alias("at"), F.concat(state["out"], F.array(own)).alias("out"))

        return _let(F.greatest(state["at"], end_of(block)), until)

    def replace(part):
        def step(state, s):
            # A span that begins inside the one before only moves its end.
            begin, end = s["start"] - part["from"], s["end"] - part["from"]
            gap = F.substring(part["text"], state["at"] + 1, F.greatest(begin - state["at"], F.lit(0)))
            mark = F.when(begin >= state["at"], F.element_at(names, s["kind"] + 1)).otherwise(F.lit(""))
            return F.struct(
                F.greatest(state["at"], end).alias("at"), F.concat(state["out"], gap, mark).alias("out")
            )

        begin = F.struct(F.lit(0).alias("at"), F.lit("").alias("out"))
        return F.aggregate(part["spans"], begin, step, lambda state: state["out"])

    own = "array<struct<from:int,text:string,spans:array<struct<start:int,kind:int,end:int>>>>"
    begin = F.struct(F.lit(0).alias("at"), F.array().cast(own).alias("out"))
    parts = F.aggregate(_blocks(spans), begin, stretch, lambda state: F.transform(state["out"], replace))
    rest = F.substr(text, end_of(spans) + 1)
    return F.when(F.size(spans) > 0, F.concat(F.array_join(parts, ""), rest)).otherwise(text)
