"""Secrets in texts: fixed patterns, and strings that a battery of randomness tests takes for random.

Every run of 20 or more characters of base64 with letters and digits is a candidate, and so are its pieces of that length
between separators, as a secret may stand in a path or a compound; of what is found, the longest counts. Its encoding is the smallest
alphabet that holds it. Three tests ask whether its symbols are random in that alphabet: chi-squared uniformity, the
number of runs of low and high symbols, and serial correlation of neighbours. A candidate that none of them
rejects (Bonferroni) is tested against ordinary text, whose letters are as frequent as in words and which seldom goes from
letters to digits or from small to capital ones: the token's chance there over its chance when random. A ratio
is below p with a chance of at most p for ordinary tokens, so it is a p-value whatever the length and the
alphabet, and shrinks with length. Benjamini-Hochberg over the candidates of an encoding sets that one's limit;
candidates that overlap a fixed pattern's match are reported anyway and do not count.
"""

from __future__ import annotations

from dataclasses import dataclass
from math import exp, inf, log

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from visitlake.llm.spans import apart_from, count_kind, digest, longest, normal_cdf, replaced, with_matches, written
from visitlake.sources.files import staged

KINDS = ("assign", "access", "hex", "random")
RANDOM_ALPHA = 0.001  # candidates that a test rejects at this level are not random
DISCOVERY_RATE = 0.01  # share of ordinary tokens among those reported as random
REDACTED = "[SECRET]"

_ASSIGN = r"""(?i:password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?"""
_PATTERNS = {
    "assign": (_ASSIGN + r"[A-Za-z0-9+/_.=-]+", ()),
    # runs that are too short fail as a whole, so the minimum can stand in the pattern
    "access": (r"AKIA[A-Z0-9]{14,}", ("AKIA",)),
    "hex": (r"[0-9a-f]{16,}", ()),
    "random": (r"[A-Za-z0-9+/_=-]{20,}", ()),
}
# Pieces of such runs: the characters beside them that make them pieces, and those that a piece without would be one of another kind.
_PIECES = {
    "plain": (r"[A-Za-z0-9]{20,}", "[+/_=-]", ""),
    "path": (r"[A-Za-z0-9+/]{20,}", "[_=-]", "[+/]"),
    "compound": (r"[A-Za-z0-9_-]{20,}", "[+/=]", "[_-]"),
}

# Alphabets in the order of their symbols' values.
_DIGITS, _LOWER, _UPPER = "0123456789", "abcdefghijklmnopqrstuvwxyz", "ABCDEFGHIJKLMNOPQRSTUVWXYZ"
_ALPHABETS = {
    "hex": _DIGITS + _LOWER[:6],
    "HEX": _DIGITS + _UPPER[:6],
    "base32": _UPPER + _DIGITS[2:8],
    "base36": _DIGITS + _LOWER,
    "BASE36": _DIGITS + _UPPER,
    "base62": _DIGITS + _UPPER + _LOWER,
    "base64": _UPPER + _LOWER + _DIGITS + "+/",
    "base64url": _UPPER + _LOWER + _DIGITS + "-_",
}

# Shares of a to z in words, in units of 0.1 %; a tenth of the letters are taken to be any.
_SHARES = (82, 15, 28, 43, 127, 22, 20, 61, 70, 2, 8, 40, 24, 67, 75, 19, 1, 60, 63, 91, 28, 10, 24, 2, 20, 1)
_LETTER = {c: 0.9 * n / sum(_SHARES) + 0.1 / 26 for c, n in zip(_LOWER, _SHARES)}
_CHANCE = _LETTER | {c.upper(): x for c, x in _LETTER.items()} | {c: 0.1 for c in _DIGITS} | {c: 0.25 for c in "+/-_"}
# Classes of symbols (digit, lower, upper, separator) and how ordinary tokens go from one to the next.
_CLASSES = {"d": _DIGITS, "l": _LOWER, "u": _UPPER, "s": "+/-_"}
_NEXT = {
    "d": {"d": 0.75, "l": 0.10, "u": 0.08, "s": 0.07}, "l": {"d": 0.03, "l": 0.88, "u": 0.05, "s": 0.04},
    "u": {"d": 0.05, "l": 0.40, "u": 0.50, "s": 0.05}, "s": {"d": 0.25, "l": 0.50, "u": 0.15, "s": 0.10},
}
_FIRST = 0.25  # chance of any class at the start
_STEPS = 50  # p-values are counted in steps of 1/50 of a natural logarithm
_LAST_STEP = 50 * 60


@dataclass(frozen=True)
class Limits:
    """What the corpus says: logarithm of the largest p-value that counts as a discovery, per encoding; none where nothing does."""

    p_value: dict[str, float]


def _inferred(token: Column) -> Column:
    """Name of the smallest alphabet that holds the token, null for none."""
    out = F.lit(None).cast("string")
    for name, alphabet in reversed(_ALPHABETS.items()):
        letters = alphabet.replace("-", r"\-").replace("+", r"\+")
        out = F.when(token.rlike(f"^[{letters}]+$"), F.lit(name)).otherwise(out)
    return out


def _tested(candidates: Column) -> Column:
    """Candidates with a letter and a digit: their encoding, the tests' p-value and the logarithm of the ordinary one."""
    alphabet_of = F.create_map(*[F.lit(x) for pair in _ALPHABETS.items() for x in pair])
    halves_of = F.create_map(*[F.lit(x) for n, a in _ALPHABETS.items() for x in (n, "0" * (len(a) // 2) + "1" * (len(a) - len(a) // 2))])

    symbols, classes = "".join("".join(x) for x in _CLASSES.values()), "".join(k * len(x) for k, x in _CLASSES.items())
    chance_of = F.create_map(*[F.lit(x) for c, p in _CHANCE.items() for x in (c, log(p))])
    step_of = F.create_map(*[F.lit(x) for a, to in _NEXT.items() for b, p in to.items() for x in (a + b, log(p))])

    def ordinary(token: Column) -> Column:
        """Logarithm of the chance of an ordinary token to be this one."""
        steps = lambda c: F.zip_with(F.slice(c, F.lit(1), F.size(c) - 1), F.slice(c, F.lit(2), F.size(c) - 1), lambda a, b: step_of[F.concat(a, b)])
        total = lambda values: F.aggregate(values, F.lit(0.0), lambda acc, x: acc + x)
        codes = F.split(F.call_function("translate", token, F.lit(symbols), F.lit(classes)), "")
        return total(F.transform(F.split(token, ""), lambda x: chance_of[x])) + total(steps(codes)) + log(_FIRST)

    def encoded(c: Column) -> Column:
        token = F.rtrim(c["match"], F.lit("="))
        return F.struct(c["start"].alias("start"), c["end"].alias("end"), c["cut"].alias("cut"), token.alias("token"), _inferred(token).alias("encoding"))

    def measured(c: Column) -> Column:
        token, alphabet = c["token"], alphabet_of[c["encoding"]]
        squares = F.aggregate(
            F.split(alphabet, ""), F.lit(0.0),
            lambda acc, symbol: acc + F.pow(F.length(token) - F.length(F.replace(token, symbol, F.lit(""))), F.lit(2.0)),
        )
        return F.struct(
            c["start"].alias("start"), c["end"].alias("end"), c["cut"].alias("cut"), c["encoding"].alias("encoding"),
            F.length(token).cast("double").alias("n"), F.length(alphabet).cast("double").alias("symbols"), squares.alias("squares"),
            ordinary(token).alias("ordinary"),
            F.call_function("translate", token, alphabet, halves_of[c["encoding"]]).alias("halves"),
            F.transform(F.split(token, ""), lambda x: F.call_function("instr", alphabet, x).cast("double")).alias("codes"),
        )

    def summed(c: Column) -> Column:
        # a field of its own, since an expression inside a lambda is evaluated anew for each element
        mean = F.aggregate(c["codes"], F.lit(0.0), lambda a, x: a + x) / c["n"]
        return F.struct(
            c["start"].alias("start"), c["end"].alias("end"), c["cut"].alias("cut"), c["encoding"].alias("encoding"), c["n"].alias("n"),
            (c["symbols"] - 1).alias("freedom"), (c["symbols"] / c["n"] * c["squares"] - c["n"]).alias("chi"),
            F.length(F.replace(c["halves"], F.lit("0"), F.lit(""))).cast("double").alias("high"),
            F.length(F.regexp_replace(c["halves"], "0+|1+", "x")).cast("double").alias("runs"),
            c["codes"].alias("codes"), mean.alias("mean"), (c["ordinary"] + c["n"] * F.ln(c["symbols"])).alias("ordinary"),
        )

    def judged(c: Column) -> Column:
        n, high, freedom = c["n"], c["high"], c["freedom"]
        two_sided = lambda z: 2 * (1 - normal_cdf(F.abs(z)))
        spread = 2 / (9 * freedom)
        uniform = 1 - normal_cdf((F.pow(c["chi"] / freedom, F.lit(1 / 3)) - (1 - spread)) / F.sqrt(spread))
        expected = 2 * high * (n - high) / n + 1
        variance = F.greatest((expected - 1) * (expected - 2) / (n - 1), F.lit(1e-9))
        runs = F.when((high == 0) | (high == n), F.lit(0.0)).otherwise(two_sided((c["runs"] - expected) / F.sqrt(variance)))
        squares = F.aggregate(c["codes"], F.lit(0.0), lambda a, x: a + (x - c["mean"]) * (x - c["mean"]))
        products = F.aggregate(
            F.zip_with(F.slice(c["codes"], F.lit(1), n.cast("int") - 1), F.slice(c["codes"], F.lit(2), n.cast("int") - 1), lambda a, b: (a - c["mean"]) * (b - c["mean"])),
            F.lit(0.0), lambda a, x: a + x,
        )
        serial = F.when(squares == 0, F.lit(0.0)).otherwise(two_sided((products / squares + 1 / n) * F.sqrt(n)))
        combined = F.least(F.lit(1.0), 3 * F.least(uniform, runs, serial))
        return F.struct(
            c["start"].alias("start"), c["end"].alias("end"), c["cut"].alias("cut"), c["encoding"].alias("encoding"),
            combined.alias("p"), c["ordinary"].alias("ordinary"),
        )

    known = F.filter(F.transform(candidates, encoded), lambda c: c["encoding"].isNotNull() & (F.length(c["token"]) >= 20)
                     & c["token"].rlike("[0-9]") & c["token"].rlike("[A-Za-z]"))
    return F.transform(F.transform(F.transform(known, measured), summed), judged)


def _ranked(spans: Column, kind: str) -> Column:
    """Spans of one kind as (start, rank, kind, end), which sort by start and then by kind as listed."""
    return F.transform(spans, lambda s: F.struct(
        s["start"].alias("start"), F.lit(KINDS.index(kind)).alias("rank"), F.lit(kind).alias("kind"), s["end"].alias("end")))


def _scanned(docs: DataFrame, text_col: str) -> DataFrame:
    """(row, text, base, tested): every row of `docs` with its base spans and its tested candidates."""
    packed = docs.select(F.struct("*").alias("row"), F.coalesce(F.col(text_col), F.lit("")).alias("text"))
    matched = with_matches(packed, "text", _PATTERNS | {f"_{name}": (pattern, ()) for name, (pattern, _, _) in _PIECES.items()})

    def cut_as(name: str, spans: Column) -> Column:
        return F.transform(spans, lambda c: F.struct(
            c["start"].alias("start"), c["end"].alias("end"), F.lit(name).alias("cut"), c["match"].alias("match")))

    def pieces_of(name: str) -> Column:
        _, beside, inside = _PIECES[name]
        return cut_as(name, F.filter(f"_{name}", lambda c: F.concat(c["left"], c["right"]).rlike(beside) & c["match"].rlike(inside)))

    valid = {
        "assign": lambda s: F.length(F.regexp_extract(s["match"], f"^{_ASSIGN}([A-Za-z0-9+/_.=-]+)$", 1)) >= 12,
        "access": lambda s: F.lit(True),
        "hex": lambda s: F.lit(True),
    }
    base = F.array_sort(F.concat(*[_ranked(F.filter(kind, valid[kind]), kind) for kind in KINDS[:3]]))
    based = matched.select("row", "text", base.alias("base"), F.concat(cut_as("random", F.col("random")), *map(pieces_of, _PIECES)).alias("candidates"))
    return based.select("row", "text", "base", _tested(apart_from(F.col("candidates"), F.col("base"), KINDS[:3])).alias("tested"))


def corpus_limits(tested: DataFrame) -> Limits:
    """Discovery limits from all candidates of the column `tested`; an aggregate of bounded size."""
    candidates = tested.select(F.explode("tested").alias("c"))
    step = F.least(F.floor(F.greatest(-F.col("c.ordinary"), F.lit(0.0)) * _STEPS), F.lit(_LAST_STEP)).cast("int")
    # tokens that a test rejects are tested too, and are not discoveries
    steps = F.when(F.col("c.p") < RANDOM_ALPHA, F.lit(0)).otherwise(step).alias("step")
    counts: dict[str, dict[int, int]] = {}
    for row in candidates.groupBy(F.col("c.encoding").alias("encoding"), steps).count().collect():
        counts.setdefault(row["encoding"], {})[row["step"]] = row["count"]
    limits = {}
    for encoding, of in counts.items():
        total, passed = sum(of.values()), 0
        for step in sorted(of, reverse=True):
            passed += of[step]
            largest = -step / _STEPS  # no p-value of this step is larger
            if exp(largest) * total <= DISCOVERY_RATE * passed:
                limits[encoding] = largest
    return Limits(limits)


def _all_spans(limits: Limits) -> Column:
    limit_of = F.create_map(*[F.lit(x) for name in _ALPHABETS for x in (name, limits.p_value.get(name, -inf))])
    random = F.filter("tested", lambda c: (c["p"] >= RANDOM_ALPHA) & (c["ordinary"] <= limit_of[c["encoding"]]))
    found = longest(random, "cut", ("random", *_PIECES))
    return F.array_sort(F.concat("base", apart_from(_ranked(found, "random"), F.col("base"), KINDS[:3])))


def scan_secrets(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(id, base, spans) of every row: arrays of (start, rank, kind, end) in order of start, then kind.

    `base` holds the matches of the fixed patterns, `spans` those and the strings taken for random that overlap none of
    them. Null and empty texts have no spans; repeated rows are scanned each, and each counts for the limits; an empty
    table gives an empty one.
    """
    found = _scanned(docs.select(id_col, text_col), text_col).select(F.col(f"row.{id_col}").alias(id_col), "base", "tested")
    stored, _ = staged(found, "secret-candidates")
    return stored.select(id_col, "base", _all_spans(corpus_limits(stored)).alias("spans"))


def secret_digest(scanned: DataFrame, id_col: str = "doc_id") -> DataFrame:
    """Counts, digest and list of the spans of `scan_secrets`."""
    base = F.col("base")
    return scanned.select(
        id_col, *[count_kind(base, kind).alias(f"n_{kind}") for kind in KINDS[:3]],
        digest(base).alias("base_sha256"), written(F.col("spans")).alias("spans"),
    )


def redact_secrets(docs: DataFrame, text_col: str = "text", length_col: str = "n_chars") -> DataFrame:
    """`docs` with every secret replaced in its text, and `length_col` (if there) counted anew where it was.

    Rows without secrets, null texts among them, stay as they are.
    """
    stored, _ = staged(_scanned(docs, text_col), "secret-scan")
    spans = stored.withColumn("spans", _all_spans(corpus_limits(stored.select("tested"))))
    clean = spans.withColumn("clean", F.when(F.size("spans") > 0, replaced(F.col("text"), F.col("spans"), KINDS, REDACTED)))
    columns = []
    for c in docs.columns:
        old = F.col("row").getField(c)
        new = {text_col: F.col("clean"), length_col: F.length("clean").cast(docs.schema[c].dataType)}.get(c)
        columns.append((old if new is None else F.coalesce(new, old)).alias(c))
    return clean.select(columns)
