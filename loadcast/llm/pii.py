"""Personal data found by labelers that vote, weighed by weak supervision (DataFrame functions only).

Candidates are spans of a whole text: the base patterns (email, ip, card,
phone) and looser ones (secret, number, name).  Regex, gazetteer, context and
shape labelers vote on every candidate; expectation-maximisation over the
counts of their vote patterns estimates how reliable they are, and its
posteriors are the soft labels that a logistic span classifier is fitted on,
from counted feature patterns (their number is bounded by the features, not by
the data).  A base span that passes its check always stays; another candidate
becomes a span if the classifier says so and it overlaps no base span.

Positions are code points, end exclusive.  They come from the lengths of the
pieces between matches, so no function is needed that Spark lacks.

Defined results: a null text is empty and has no spans; repeated rows and
equal ids are handled row by row; an empty table gives an empty table.
"""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass

import numpy as np
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import fresh, materialize
from .quality import fit_votes

# The four base kinds, in order.  The patterns are written so that they match what
#   [A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+
#   [0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)
#   [0-9]([\x20-]?[0-9])+
#   \+[0-9][\x20().0-9-]+[0-9]
# match, without recursion or quadratic time on long runs: nothing that follows a possessive
# quantifier could use what it took, and a match that starts inside a run starts at its
# beginning or where the last match ended (\G).
BASE = {
    "email": r"(?:(?<![A-Za-z0-9._%+-])|\G)[A-Za-z0-9._%+-]++@[A-Za-z0-9-]++(?:\.[A-Za-z0-9-]++)++",
    "ip": r"(?:(?<![0-9])|\G)[0-9]++(?:\.[0-9]++){3}",
    "card": r"[0-9](?:[\x20-]?[0-9])++",
    "phone": r"\+[0-9][\x20().0-9-]+[0-9]",
}
#: A cheap look whether the text can have a match at all.
NEEDS = {"email": "@", "ip": r"[0-9]\.[0-9]", "card": r"[0-9](?:[\x20-]?[0-9]){15}", "phone": r"\+[0-9]"}

# Word lists of the labelers.
FIRST_NAMES = (
    "James Mary John Patricia Robert Jennifer Michael Linda William Elizabeth David Barbara Richard Susan Joseph "
    "Jessica Thomas Sarah Charles Karen Anna Maria Peter Paul Laura Carlos Sofia Hans Marie Pierre"
).split()
TITLES = "Mr Mrs Ms Dr Prof Herr Frau Monsieur Madame Don".split()
SECRET_WORDS = "password passwd pwd secret token apikey api_key access_key secret_key private_key".split()
PRIVATE_WORDS = [*SECRET_WORDS, "key", "ssn", "iban", "account", "phone", "tel", "call", "contact", "passport"]
PUBLIC_WORDS = "version vol page isbn issn doi figure section chapter".split()

LOOSE = {
    "secret": r"\b(?i:" + "|".join(SECRET_WORDS) + r")[\x20\"']{0,2}[=:][\x20\"']{0,2}[^\x20\x09-\x0D\"']{6,}+"
    r"|(?<![A-Za-z0-9_/+-])(?=[A-Za-z_/+-]*+[0-9])(?=[0-9_/+-]*+[A-Za-z])[A-Za-z0-9_/+-]{16,}+(?!@)",
    "number": r"(?<![0-9+.-])[0-9]{3}-[0-9]{2}-[0-9]{4}(?![0-9-])|(?<![0-9+).-])\(?[0-9]{3}\)?[\x20.-][0-9]{3}[.-][0-9]{4}(?![0-9-])",
    "name": r"\b(?:" + "|".join(TITLES) + r")\.?\x20\p{Lu}\p{Ll}{1,30}(?:\x20\p{Lu}\p{Ll}{1,30})?"
    r"|\b(?:" + "|".join(FIRST_NAMES) + r")\x20\p{Lu}\p{Ll}{1,30}",
}
LOOSE_NEEDS = {"secret": r"[0-9]|(?i:" + "|".join(SECRET_WORDS) + ")", "number": r"[0-9]{3}[.-][0-9]{4}|[0-9]{2}-[0-9]{4}", "name": r"\b(?:" + "|".join([*TITLES, *FIRST_NAMES]) + r")\b"}
KINDS = [*BASE, *LOOSE]
_SPAN = "struct<kind:string,start:int,end:int,text:string,before:string>"
_CONTEXT = 24
#: Items of an array that a pass takes together.
_PART = 64
#: Characters of the blocks that a text is cut out of.
_BLOCK = 256


def running(items: Column, begin: Column, step: Callable[[Column, Column], tuple[Column, Column]], emits: str, part: int = _PART) -> Column:
    """A pass over an array that carries a state and emits an element of type ``emits`` for each item:
    step(state, item) -> (state, element).  Gives struct(state, out).

    What was emitted is copied with every item of a part and with every part, so long arrays go
    by parts of ``part`` items; the lambdas bind what would be computed again otherwise.
    """

    def within(state: Column, some: Column) -> Column:
        def one(acc: Column, x: Column) -> Column:
            after, element = step(acc["state"], x)
            return F.struct(after.alias("state"), F.concat(acc["out"], F.array(element)).alias("out"))

        return F.aggregate(some, F.struct(state.alias("state"), F.array().cast(f"array<{emits}>").alias("out")), one)

    def whole(xs: Column) -> Column:
        def one(acc: Column, i: Column) -> Column:
            done = F.array(within(acc["state"], F.slice(xs, i * part + 1, F.lit(part))))
            return F.transform(done, lambda r: F.struct(r["state"].alias("state"), F.concat(acc["out"], F.array(r["out"])).alias("out")))[0]

        parts = F.sequence(F.lit(0), F.floor((F.size(xs) - 1) / part).cast("int"), F.lit(1))
        start = F.struct(begin.alias("state"), F.array().cast(f"array<array<{emits}>>").alias("out"))
        return F.aggregate(parts, start, one, lambda acc: F.struct(acc["state"].alias("state"), F.flatten(acc["out"]).alias("out")))

    nothing = F.struct(begin.alias("state"), F.array().cast(f"array<{emits}>").alias("out"))
    return F.transform(F.array(items), lambda xs: F.when(F.size(xs) == 0, nothing).otherwise(whole(xs)))[0]


def _spans(text: Column, kind: str, pattern: str, needs: str) -> Column:
    """All matches: kind, start, end, text, and the characters before it."""
    possible = text.contains(needs) if needs == "@" else text.rlike(needs)
    pieces = F.split(text, pattern, -1)
    around = F.arrays_zip(
        F.transform(pieces, lambda p: F.length(p)).alias("gap"),
        F.transform(pieces, lambda p: F.right(p, F.lit(_CONTEXT))).alias("before"),
        F.regexp_extract_all(text, F.lit(pattern), F.lit(0)).alias("match"),
    )

    def step(at: Column, x: Column) -> tuple[Column, Column]:
        start = at + x["gap"]
        end = start + F.length(x["match"])
        return end, F.struct(F.lit(kind).alias("kind"), start.alias("start"), end.alias("end"), x["match"].alias("text"), x["before"].alias("before"))

    matches = F.filter(around, lambda x: x["match"].isNotNull())  # the last piece has no match after it
    return F.when(possible, running(matches, F.lit(0), step, _SPAN)["out"]).otherwise(F.array().cast(f"array<{_SPAN}>"))


def _digits(text: Column) -> Column:
    return F.regexp_replace(text, "[^0-9]", "")


def _luhn(digits: Column) -> Column:
    def weighed(i: Column) -> Column:
        d = F.substring(digits, F.length(digits) - i, F.lit(1)).cast("int")
        return F.when(i % 2 == 0, d).when(d > 4, 2 * d - 9).otherwise(2 * d)

    places = F.sequence(F.lit(0), F.length(digits) - 1)
    return F.aggregate(F.transform(places, weighed), F.lit(0), lambda a, b: a + b) % 10 == 0


def _small_part(part: Column) -> Column:
    plain = F.regexp_replace(part, "^0+(?=[0-9])", "")
    return F.when(F.length(plain) <= 3, plain.cast("int") <= 255).otherwise(F.lit(False))


CHECKS = {
    "email": lambda t: F.lit(True),
    "ip": lambda t: F.forall(F.split(t, r"\."), _small_part),
    "card": lambda t: F.when(F.length(_digits(t)).between(16, 19), _luhn(_digits(t))).otherwise(F.lit(False)),
    "phone": lambda t: F.length(_digits(t)).between(8, 15),
}


def find_base(text: Column) -> Column:
    """Base spans by kind, then start."""

    def checked(kind: str, pattern: str) -> Column:
        return F.filter(_spans(text, kind, pattern, NEEDS[kind]), lambda s: CHECKS[kind](s["text"]))

    return F.concat(*[checked(kind, pattern) for kind, pattern in BASE.items()])


def find_loose(text: Column) -> Column:
    return F.concat(*[_spans(text, k, p, LOOSE_NEEDS[k]) for k, p in LOOSE.items()])


def _any(words: list[str], after: str) -> str:
    return r"(?i)\b(?:" + "|".join(words) + ")" + after


#: name -> vote on a span (struct): +1 personal, -1 not, 0 abstains.
LABELERS = {
    "checked_format": lambda s: F.when(s["kind"].isin(*BASE), 1).otherwise(0),
    "key_format": lambda s: F.when(
        s["text"].rlike(r"^(?:AKIA[0-9A-Z]{16}|gh[pousr]_[A-Za-z0-9]{20,}|sk-[A-Za-z0-9-]{16,}|[0-9a-f]{32,64}|[A-Z]{2}[0-9]{2}[A-Z0-9]{11,30})$"), 1
    ).when((s["kind"] == "secret") & s["text"].rlike(r"[/]|^[a-z]++(?:[-_][a-z]++)++[0-9]*+$"), -1).otherwise(0),
    "gazetteer": lambda s: F.when(s["text"].rlike(_any([*FIRST_NAMES, *TITLES, *SECRET_WORDS], r"\b")), 1).when(s["kind"] == "name", -1).otherwise(0),
    "context": lambda s: F.when(
        F.concat(s["before"], F.when(s["kind"] == "secret", s["text"]).otherwise(F.lit(""))).rlike(_any(PRIVATE_WORDS, r"\b[^A-Za-z]{0,4}"))
        | s["before"].rlike(_any(TITLES, r"\.?[^A-Za-z]{0,2}$")), 1
    ).when(s["before"].rlike(_any(PUBLIC_WORDS, r"\b[^A-Za-z]{0,4}$")), -1).otherwise(0),
    "variety": lambda s: F.when(s["kind"] == "name", 0).when(F.size(F.array_distinct(F.split(s["text"], ""))) >= 7, 1).otherwise(-1),
}
_FEATURES = ["bias", *(f"is_{k}" for k in KINDS), *(f"{n}_{v}" for n in LABELERS for v in ("yes", "no")), "short", "long", "capitals"]


def judged(spans: Column) -> Column:
    """Spans with the labelers' votes, and the shape the classifier looks at besides."""

    def one(s: Column) -> Column:
        length = s["end"] - s["start"]
        votes = F.array(*[vote(s).cast("int") for vote in LABELERS.values()])
        shape = F.array(*[c.cast("int") for c in (length <= 12, length > 32, s["text"].rlike("^[A-Z0-9]+$"))])
        return F.struct(s["kind"].alias("kind"), s["start"].alias("start"), s["end"].alias("end"), votes.alias("votes"), shape.alias("shape"))

    return F.transform(spans, one)


@dataclass(frozen=True)
class SpanModel:
    weights: tuple[float, ...]

    def accepts(self, s: Column) -> Column:
        kinds, rest = self.weights[1 : 1 + len(KINDS)], self.weights[1 + len(KINDS) :]
        score = F.lit(self.weights[0])
        for kind, w in zip(KINDS, kinds, strict=True):
            score = score + F.when(s["kind"] == kind, w).otherwise(0.0)
        for j in range(len(LABELERS)):
            vote = s["votes"][j]
            score = score + F.when(vote > 0, rest[2 * j]).when(vote < 0, rest[2 * j + 1]).otherwise(0.0)
        for j, w in enumerate(rest[2 * len(LABELERS) :]):
            score = score + s["shape"][j] * w
        return score >= 0


def fit_spans(patterns: dict[tuple, int], rounds: int = 400) -> SpanModel:
    """patterns: (kind, votes, shape) -> count.  Soft labels by EM over the votes, then a logistic
    regression (weighted by the counts, with a small L2 penalty) on them."""
    votes: dict[tuple[int, ...], int] = {}
    for (_, v, _), n in patterns.items():
        votes[v] = votes.get(v, 0) + n
    model = fit_votes(votes, len(LABELERS))
    up, down = model.weights()
    if not patterns:
        flat = [x for pair in zip(up, down, strict=True) for x in pair]
        return SpanModel((float(np.log(model.prior / (1 - model.prior))), *[0.0] * len(KINDS), *map(float, flat), 0.0, 0.0, 0.0))
    keys = sorted(patterns)
    v = np.array([k[1] for k in keys], dtype=float)
    odds = np.log(model.prior / (1 - model.prior)) + (v > 0) @ up + (v < 0) @ down
    label = 1 / (1 + np.exp(-np.clip(odds, -500, 500)))
    weight = np.sqrt([patterns[k] for k in keys])  # a common pattern shouldn't drown the rest
    weight /= weight.sum()
    x = np.array([
        [1.0, *(float(k[0] == kind) for kind in KINDS), *(float(f(a)) for a in k[1] for f in (lambda a: a > 0, lambda a: a < 0)), *map(float, k[2])]
        for k in keys
    ])
    w = np.zeros(x.shape[1])
    for _ in range(rounds):
        p = 1 / (1 + np.exp(-x @ w))
        w -= 4.0 * (x.T @ (weight * (p - label)) + 1e-4 * w)
    return SpanModel(tuple(map(float, w)))


def fit(found: DataFrame, base: str = "base", loose: str = "loose") -> SpanModel:
    """Fit on the candidates of all rows (only counted patterns come to the driver)."""
    counted = found.select(F.explode(F.concat(base, loose)).alias("s")).groupBy("s.kind", "s.votes", "s.shape").count()
    return fit_spans({(r["kind"], tuple(r["votes"]), tuple(r["shape"])): r["count"] for r in counted.collect()})


def _free(loose: Column, base: Column) -> Column:
    """The spans of ``loose`` that overlap none of ``base``, in their order.

    Both are ordered by start together; one pass forward meets the furthest end of
    the base spans so far, one backward the next base span's start.
    """
    kind = "struct<start:int,end:int,at:int,hit:boolean>"

    def marked(spans: Column, is_loose: bool) -> Column:
        place = lambda i: i if is_loose else F.lit(-1)
        # at one start, base spans come first
        return F.transform(spans, lambda s, i: F.struct(s["start"].alias("start"), place(i).alias("at"), s["end"].alias("end")))

    def element(s: Column, hit: Column) -> Column:
        return F.struct(s["start"].alias("start"), s["end"].alias("end"), s["at"].alias("at"), hit.alias("hit"))

    def forward(edge: Column, s: Column) -> tuple[Column, Column]:
        is_base = s["at"] < 0
        return F.when(is_base, F.greatest(edge, s["end"])).otherwise(edge), element(s, ~is_base & (edge > s["start"]))

    def backward(edge: Column, s: Column) -> tuple[Column, Column]:
        is_base = s["at"] < 0
        return F.when(is_base, s["start"]).otherwise(edge), element(s, is_base | s["hit"] | (edge < s["end"]))

    ordered = F.array_sort(F.concat(marked(base, False), marked(loose, True)))
    once = running(ordered, F.lit(-1), forward, kind)["out"]
    twice = running(F.reverse(once), F.lit(2**31 - 1), backward, kind)["out"]
    kept = F.array_sort(F.transform(F.filter(twice, lambda s: ~s["hit"]), lambda s: s["at"]))
    return F.when((F.size(base) == 0) | (F.size(loose) == 0), loose).otherwise(F.transform(kept, lambda i: F.get(loose, i)))


def accepted(model: SpanModel, base: Column, loose: Column) -> Column:
    """Base spans, then the other kinds in order; by start within a kind."""
    taken = F.transform(F.array(F.filter(loose, model.accepts)), lambda kept: _free(kept, base))[0]  # filtered once
    return F.concat(base, taken)


def _listed(spans: Column) -> Column:
    return F.array_join(F.transform(spans, lambda s: F.concat_ws(":", s["kind"], s["start"], s["end"])), ",")


def with_candidates(docs: DataFrame, text: str, base: str, loose: str) -> DataFrame:
    whole = F.coalesce(F.col(text), F.lit(""))
    return docs.withColumns({base: judged(find_base(whole)), loose: judged(find_loose(whole))})


def pii_report(docs: DataFrame, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """doc_id, n_email, n_ip, n_card, n_phone, base_sha256, spans of every row."""
    wanted = docs.select(F.col(doc_id).alias("doc_id"), F.col(text).alias("text"))
    found = materialize(with_candidates(wanted, "text", "base", "loose").drop("text"), "pii-candidates")
    model = fit(found)
    kinds = F.transform("base", lambda s: s["kind"])
    count = {f"n_{k}": F.size(F.filter(kinds, lambda x: x == k)).cast("long") for k in BASE}  # noqa: B023 (called at once)
    return found.select(
        "doc_id",
        *[c.alias(n) for n, c in count.items()],
        F.sha2(_listed(F.col("base")), 256).alias("base_sha256"),
        _listed(accepted(model, F.col("base"), F.col("loose"))).alias("spans"),
    )


def redacted(text: Column, spans: Column) -> Column:
    """The text with every span (overlapping ones as one) replaced by its kind in brackets.

    One pass over the spans by start carries the one that is still open and its
    furthest end; one that begins behind that end closes it.  Every closed span
    keeps the end before it, so the pieces between are cut without looking back, out of
    the few blocks of the text that they lie in.
    """
    blocks = F.regexp_extract_all(text, F.lit(f"(?s).{{1,{_BLOCK}}}"), F.lit(0))
    masked = F.transform(F.array(blocks), lambda b: _masked(b, spans))[0]
    return F.when(F.size(spans) == 0, text).otherwise(masked)


def _masked(blocks: Column, spans: Column) -> Column:
    """``redacted`` of a text in blocks of ``_BLOCK`` characters."""

    def between(start: Column, end: Column | None) -> Column:
        first = F.floor(start / _BLOCK).cast("int")
        last = F.size(blocks) if end is None else F.floor(end / _BLOCK).cast("int")
        near = F.array_join(F.slice(blocks, first + 1, last - first + 1), "")
        return F.substring(near, start % _BLOCK + 1, F.length(near) if end is None else end - start)

    ordered = F.array_sort(F.transform(spans, lambda s: F.struct(s["start"].alias("start"), s["end"].alias("end"), s["kind"].alias("kind"))))

    def state(since: Column, start: Column, end: Column, kind: Column) -> Column:
        return F.struct(since.alias("since"), start.alias("start"), end.alias("end"), kind.alias("kind"))

    def step(acc: Column, s: Column) -> tuple[Column, Column]:
        closes = acc["start"].isNotNull() & (acc["end"] <= s["start"])
        grown = state(acc["since"], acc["start"], F.greatest(acc["end"], s["end"]), acc["kind"])
        after = F.when(acc["start"].isNull(), state(F.lit(0), s["start"], s["end"], s["kind"])).when(closes, state(acc["end"], s["start"], s["end"], s["kind"])).otherwise(grown)
        return after, F.when(closes, mask(acc))

    def mask(s: Column) -> Column:
        """The text since the last span, and this one's mask."""
        return F.concat(between(s["since"], s["start"]), F.lit("["), F.upper(s["kind"]), F.lit("]"))

    none = F.lit(None).cast("int")
    passed = running(ordered, state(F.lit(0), none, none, F.lit(None).cast("string")), step, "string")

    def joined(r: Column) -> Column:
        """What was closed, the span left open, and the rest of the text."""
        return F.concat(F.array_join(r["out"], ""), mask(r["state"]), between(r["state"]["end"], None))

    return F.transform(F.array(passed), joined)[0]


def redact(docs: DataFrame, text: str = "text", n_chars: str = "n_chars") -> DataFrame:
    """``docs`` with the spans masked in the text; ``n_chars``, if there is such a column, follows."""
    base, loose, spans = (fresh(docs.columns, n) for n in ("_base", "_loose", "_spans"))
    found = materialize(with_candidates(docs, text, base, loose), "pii-candidates")  # with the rows, so that none is searched twice
    model = fit(found, base, loose)
    out = found.withColumn(spans, accepted(model, F.col(base), F.col(loose))).withColumn(text, redacted(F.col(text), F.col(spans)))
    if n_chars in docs.columns:
        changed = F.when(F.size(spans) > 0, F.length(text).cast("long")).otherwise(F.col(n_chars))
        out = out.withColumn(n_chars, changed.cast(docs.schema[n_chars].dataType))
    return out.select(*docs.columns)
