"""Personal data in texts by weak supervision.

Fixed patterns find base spans, wider ones find further candidates (addresses written with [at] and [dot], telephone numbers
without a country code, IPv6 addresses). Labelers vote 1, 0 or -1 on every candidate: whether the fixed pattern and its
check hold, structure, a gazetteer, words before it, and the characters at its borders. Expectation-maximisation
over the counts of vote patterns estimates how reliable each labeler is, without any labelled row. The
resulting probabilities are the soft labels of a naive Bayes classifier over the shape and surroundings of spans, and
that classifier decides which candidates join the base spans.
"""

from __future__ import annotations

import math
from collections import defaultdict
from collections.abc import Iterable
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from visitlake.llm.spans import apart_from, count_kind, digest, of_kind, with_matches, written
from visitlake.sources.files import staged

KINDS = ("email", "ip", "card", "phone")
LABELERS = ("pattern", "structure", "gazetteer", "context", "border")
ACCEPT = 0.9  # probability from which the classifier adds a candidate
SHAPES = 64  # values that shapes of spans are hashed to
CONTEXT = 40  # characters looked at beside a match
EM_ROUNDS = 50
PRIOR_RIGHT, PRIOR_WRONG = 8.0, 2.0

_LOCAL, _DOMAIN = r"[A-Za-z0-9._%+-]", r"[A-Za-z0-9-]"
_AT, _DOT = r"\x20?(?:\[at\]|\(at\))\x20?", r"(?:\x20?(?:\[dot\]|\(dot\))\x20?|\.)"
_PATTERNS = {
    # a match starts where its run of characters does, or where the match before it ended
    "email": (rf"(?:\G|(?<!{_LOCAL})){_LOCAL}++@{_DOMAIN}++(?:\.{_DOMAIN}++)++", ("@",)),
    "ip": (r"(?<![0-9])[0-9]++(?:\.[0-9]++){3}", ()),
    # shorter numbers fail as a whole, so the minimum can stand in the pattern
    "card": (r"[0-9](?:[\x20-]?[0-9]){12,}+", ()),
    "phone": (r"\+[0-9][\x20().0-9-]+[0-9]", ("+",)),
    "wide_email": (rf"(?<!{_LOCAL}){_LOCAL}{{1,64}}{_AT}{_DOMAIN}{{1,63}}(?:{_DOT}{_DOMAIN}{{1,63}}){{1,5}}", ("[at]", "(at)")),
    "wide_ip": (r"(?<![0-9A-Fa-f:])(?:[0-9A-Fa-f]{1,4}:){7}[0-9A-Fa-f]{1,4}(?![0-9A-Fa-f:])", (":",)),
    "wide_phone": (r"(?<![0-9+(.-])(?:\([0-9]{3}\)\x20?|[0-9]{3}[.-])[0-9]{3}[.-][0-9]{4}(?![0-9]|[.-][0-9])", ()),
}

# Gazetteers and the words labelers look for.
_TOP_DOMAINS = (
    "com org net edu gov mil int info biz io co dev app de fr es it nl be ch at uk ie us ca mx br ar cl au nz jp cn in kr "
    "ru pl cz se no dk fi pt gr tr za eu"
).split()
_COUNTRY_CODES = r"^(1|7|20|27|3[0-469]|4[013-9]|5[1-8]|6[0-6]|8[1246]|9[0-58])"
_CARD_ISSUERS = r"^(4|5[1-5]|2[2-7]|3[0-9]|6[0-9])"
_CUES = {
    "email": r"e-?mail|contact|write to|mailto|correo|courriel|kontakt",
    "ip": r"\bip\b|address|host|server|login|client|from",
    "card": r"card|visa|mastercard|amex|credit|debit|payment|tarjeta|carte|karte|iban",
    "phone": r"phone|tel|call|mobile|cell|fax|whatsapp|tele|llam|appel|ruf",
}
_AGAINST = r"version|isbn|order|invoice|ticket|serial|part|build|release|page|section"


@dataclass(frozen=True)
class SpanModel:
    """Log odds of a kind and of each of its features; unknown features say nothing."""

    prior: dict[str, float]
    features: dict[str, float]


def luhn(digits: Column) -> Column:
    """Whether a string of digits has a valid check digit."""
    def weight(k: Column) -> Column:
        d = F.substring(digits, -k, F.lit(1)).cast("int")
        return F.when(k % 2 == 1, d).otherwise(2 * d - F.when(d > 4, 9).otherwise(0))

    places = F.sequence(F.lit(1), F.greatest(F.length(digits), F.lit(1)))
    return F.aggregate(places, F.lit(0), lambda acc, k: (acc + weight(k)).cast("int")) % 10 == 0


def _digits(match: Column) -> Column:
    return F.regexp_replace(match, "[^0-9]", "")


_BYTE = r"^0*(25[0-5]|2[0-4][0-9]|1?[0-9]?[0-9])$"


def _valid(kind: str, match: Column) -> Column:
    """The check that base matches have to pass."""
    digits = _digits(match)
    if kind == "email":
        return F.lit(True)
    if kind == "ip":
        return F.forall(F.split(match, r"\."), lambda p: p.rlike(_BYTE))
    if kind == "card":
        return F.when(F.length(digits).between(13, 19), luhn(digits)).otherwise(False)
    return F.length(digits).between(9, 15)


def _vote(yes: Column, no: Column | None = None) -> Column:
    """1, -1 or 0; without `no`, what is not yes votes -1."""
    other = F.lit(-1) if no is None else F.when(no, -1).otherwise(0)
    return F.when(yes, 1).otherwise(other)


def _votes(kind: str, s: Column, wide: bool, valid: Column) -> Column:
    """The labelers' votes on a match as text, such as `1,1,0,-1,1`."""
    match, digits = s["match"], _digits(s["match"])
    top = F.lower(F.regexp_extract(match, r"([A-Za-z0-9-]+)$", 1))
    structure = {
        "email": _vote(top.rlike("^[a-z]{2,24}$") & ~match.rlike(r"\.\.|^\.")),
        "ip": _vote(F.lit(True) if wide else ~match.rlike(r"(^|\.)0[0-9]")),
        "card": _vote(valid),
        "phone": _vote(F.length(digits).between(10, 13)),
    }[kind]
    gazetteer = {
        "email": _vote(top.isin(_TOP_DOMAINS)),
        "ip": F.lit(0) if wide else _vote(F.lit(False), match.rlike(r"^(0|255|22[4-9]|23[0-9]|24[0-9]|25[0-4])\.")),
        "card": _vote(digits.rlike(_CARD_ISSUERS)),
        "phone": _vote(digits.rlike(r"^[2-9][0-9]{2}[2-9]")) if wide else _vote(digits.rlike(_COUNTRY_CODES)),
    }[kind]
    left = F.lower(s["left"])
    return F.concat_ws(
        ",", F.lit(0) if wide else _vote(valid), structure, gazetteer, _vote(left.rlike(_CUES[kind]), left.rlike(_AGAINST)),
        _vote(~s["left"].rlike(r"[\p{L}\p{N}_/#=]$") & ~s["right"].rlike(r"^[\p{L}\p{N}_/]")),
    )


def _features(kind: str, s: Column, wide: bool) -> Column:
    """What the span classifier looks at: binned shape and surroundings, `kind|name=value`.

    Shapes are hashed to SHAPES values, so a kind has at most SHAPES + 45 features whatever the texts hold.
    """
    match = s["match"]
    shape = F.regexp_replace(F.regexp_replace(F.regexp_replace(match, r"[0-9]+", "9"), r"\p{L}+", "a"), r"(.{12}).+", "$1~")
    values = {
        "wide": F.lit(str(wide)),
        "length": F.least(F.floor(F.length(match) / 4), F.lit(10)).cast("string"),
        "shape": F.pmod(F.xxhash64(shape), F.lit(SHAPES)).cast("string") if kind != "email" else F.lit("-"),
        "digits": F.floor(4 * F.length(_digits(match)) / F.length(match)).cast("string"),
        "before": F.regexp_replace(F.regexp_replace(F.right(s["left"], F.lit(1)), r"\p{L}", "a"), r"[^a\x20\n(:=,;\"]", "?"),
        "after": F.regexp_replace(F.regexp_replace(F.left(s["right"], F.lit(1)), r"\p{L}", "a"), r"[^a\x20\n).,;:\"]", "?"),
        "cue": F.lower(s["left"]).rlike(_CUES[kind]).cast("string"),
        "against": F.lower(s["left"]).rlike(_AGAINST).cast("string"),
    }
    return F.array(*[F.concat(F.lit(f"{kind}|{name}="), value) for name, value in values.items()])


def _scanned(docs: DataFrame, text_col: str) -> DataFrame:
    """(row, text, candidates): every row of `docs` with its judged candidates by kind, then start."""
    packed = docs.select(F.struct("*").alias("row"), F.coalesce(F.col(text_col), F.lit("")).alias("text"))
    matched = with_matches(packed, "text", _PATTERNS, CONTEXT)

    def candidates(kind: str, wide: bool) -> Column:
        def checked(s: Column) -> Column:
            # the check is a field of its own, so that votes read it and do not repeat it
            return F.struct(s.alias("s"), (F.lit(False) if wide else _valid(kind, s["match"])).alias("valid"))

        def judged(c: Column) -> Column:
            s = c["s"]
            return F.struct(
                F.lit(kind).alias("kind"), s["start"].alias("start"), s["end"].alias("end"), c["valid"].alias("base"),
                F.lit(wide).alias("wide"), _votes(kind, s, wide, c["valid"]).alias("votes"), _features(kind, s, wide).alias("features"),
            )

        return F.transform(F.transform(F.col(f"wide_{kind}" if wide else kind), checked), judged)

    found = [candidates(k.removeprefix("wide_"), k.startswith("wide_")) for kind in KINDS for k in (kind, f"wide_{kind}") if k in _PATTERNS]
    return matched.select("row", "text", F.concat(*found).alias("candidates"))


def estimate_reliabilities(counts: dict[tuple[int, ...], int], rounds: int = EM_ROUNDS) -> dict[tuple[int, ...], float]:
    """Probability that a span of each vote pattern is personal data, from how often the patterns occur.

    Labelers are taken as independent given the truth. A labeler that votes is right with one chance where the truth is yes and
    another where it is no, neither below one half; that it abstains says nothing. Expectation-maximisation starts
    from the majority, and every labeler starts with PRIOR_RIGHT right and PRIOR_WRONG wrong votes of either kind.
    """
    chance = {v: 1 / (1 + math.exp(-sum(v))) for v in counts}
    labelers = range(len(next(iter(counts), ())))
    for _ in range(rounds):
        yes = 1 + sum(n * chance[v] for v, n in counts.items())
        no = 1 + sum(n * (1 - chance[v]) for v, n in counts.items())
        right = [[[PRIOR_WRONG, PRIOR_RIGHT] for _ in labelers] for _ in (0, 1)]
        for votes, n in counts.items():
            for truth, share in ((1, chance[votes]), (0, 1 - chance[votes])):
                for labeler, vote in enumerate(votes):
                    if vote:
                        right[truth][labeler][(vote > 0) == truth] += n * share
        sure = [[max(0.5, w[1] / sum(w)) for w in right[truth]] for truth in (0, 1)]
        for votes in counts:
            odds = math.log(yes / no)
            for labeler, vote in enumerate(votes):
                if vote:
                    when_no, when_yes = sure[0][labeler], sure[1][labeler]
                    odds += math.log(when_yes / (1 - when_no)) if vote > 0 else math.log((1 - when_yes) / when_no)
            chance[votes] = 1 / (1 + math.exp(-max(-30.0, min(30.0, odds))))
    return chance


def train_span_model(rows: Iterable[tuple[str, str, str, int]]) -> SpanModel:
    """Naive Bayes from counts of (kind, votes, feature, n) rows, with the patterns' probabilities as soft labels.

    The feature `<kind>|` stands for the candidate itself.
    """
    patterns: dict[str, dict[tuple[int, ...], int]] = defaultdict(lambda: defaultdict(int))
    rows = [(kind, tuple(map(int, votes.split(","))), feature, n) for kind, votes, feature, n in rows]
    for kind, votes, feature, n in rows:
        if feature == f"{kind}|":
            patterns[kind][votes] += n
    chances = {kind: estimate_reliabilities(counts) for kind, counts in patterns.items()}
    sums: dict[str, list[float]] = defaultdict(lambda: [0.0, 0.0])
    for kind, votes, feature, n in rows:
        chance = chances[kind][votes]
        sums[feature][1] += n * chance
        sums[feature][0] += n * (1 - chance)
    prior, features = {}, {}
    for feature, (no, yes) in sums.items():
        kind = feature.split("|")[0]
        all_no, all_yes = sums[f"{kind}|"]
        share = (all_yes + 0.5) / (all_yes + all_no + 1)
        # one more span of the kind's own odds: a feature seldom seen says little
        log_odds = lambda n, y: math.log((y + share) / (n + 1 - share))
        prior[kind] = log_odds(all_no, all_yes)
        features[feature] = log_odds(no, yes) - prior[kind]
    return SpanModel(prior, features)


def _table(values: dict[str, float]) -> Column:
    if not values:
        return F.create_map(F.lit(""), F.lit(0.0))
    return F.create_map(*[F.lit(x) for pair in sorted(values.items()) for x in pair])


def fit(scanned: DataFrame) -> SpanModel:
    """Model from the column `candidates`: one aggregate over kinds, vote patterns and binned features."""
    spans = scanned.select(F.explode("candidates").alias("c"))
    named = F.concat(F.col("c.features"), F.array(F.concat(F.col("c.kind"), F.lit("|"))))
    counts = spans.select("c.kind", "c.votes", F.explode(named).alias("feature")).groupBy("kind", "votes", "feature").count()
    return train_span_model(tuple(r) for r in sorted(counts.collect()))


def _accepted(model: SpanModel, c: Column) -> Column:
    odds = F.aggregate(
        c["features"], F.coalesce(F.try_element_at(_table(model.prior), c["kind"]), F.lit(0.0)),
        lambda acc, f: acc + F.coalesce(F.try_element_at(_table(model.features), f), F.lit(0.0)),
    )
    return odds >= math.log(ACCEPT / (1 - ACCEPT))


def _bare(spans: Column) -> Column:
    return F.transform(spans, lambda c: F.struct(c["kind"].alias("kind"), c["start"].alias("start"), c["end"].alias("end")))


def find_personal_data(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(id, base, spans) of every row: arrays of (kind, start, end) by kind as listed, then start.

    `base` holds the matches of the fixed patterns that pass their check; `spans` holds those and the wider candidates that the
    classifier accepts and that overlap no base span. Null and empty texts have none; repeated rows are scanned
    each, and each counts for the estimates; an empty table gives an empty one.
    """
    found = _scanned(docs.select(id_col, text_col), text_col).select(F.col(f"row.{id_col}").alias(id_col), "candidates")
    stored, _ = staged(found, "personal-data")
    model = fit(stored)
    base = F.filter("candidates", lambda c: c["base"])
    added = F.filter("candidates", lambda c: c["wide"] & _accepted(model, c))
    split = stored.select(id_col, _bare(base).alias("base"), _bare(added).alias("added"))
    extra = apart_from(F.col("added"), F.col("base"), KINDS)
    by_kind = [F.array_sort(F.filter(F.concat("base", extra), of_kind(kind))) for kind in KINDS]
    return split.select(id_col, "base", F.concat(*by_kind).alias("spans"))


def personal_data_digest(found: DataFrame, id_col: str = "doc_id") -> DataFrame:
    """Counts, digest and list of the spans of `find_personal_data`."""
    base = F.col("base")
    return found.select(
        id_col, *[count_kind(base, kind).alias(f"n_{kind}") for kind in KINDS],
        digest(base).alias("base_sha256"), written(F.col("spans")).alias("spans"),
    )
