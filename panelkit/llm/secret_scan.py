"""Secrets in texts: fixed patterns, and strings that a battery of randomness tests tells from language.

Candidates are long strings of encoded characters. For each, the smallest alphabet that holds it is taken as its
encoding. The null hypothesis is that the string is *not* random: that it is language (words, identifiers, paths, numbers,
in any case and order) or goes through the alphabet in small steps. Its p-value is the ratio of its probability under the
null to that of independent uniform draws from the alphabet. The mean of the inverse under the null is 1, so by Markov's
inequality no table of critical values is needed at any length: each symbol adds its share, and 20 symbols are enough.
The null takes the larger of two models: pairs of neighbouring symbols as in text (``PAIRS``) with the changes between
cases, and steps of at most one place in the alphabet.

Three tests then ask whether the symbols are independent uniform draws at all:

* chi-squared: counts of the symbols against equal counts;
* runs: changes between the lower and the upper half of the alphabet;
* serial correlation of neighbouring symbols.

A string that departs in one of them, beyond chance and at least as far as ``Encoding`` says, has p = 1: repeats, UUIDs,
tables. On short strings the three alone cannot tell language from randomness, since halves of an alphabet alternate in
words as they do in random strings.

Over all candidates of the corpus, in strata of length, the step-up procedure of Benjamini and Hochberg keeps the
expected share of false findings below ``rate``; p-values are rounded up to a grid, which can only make it stricter, so
that the corpus sends a histogram of fixed size instead of a sorted list.

Everything is DataFrame expressions. Positions come from the pieces between matches, which Spark's ``split`` gives.

Defined results: a null text is empty; texts without findings have empty spans; rows that repeat a doc_id are scanned
one by one; an empty table gives no rows; other columns are ignored by ``scan`` and kept by ``redact``.
"""

from __future__ import annotations

from dataclasses import dataclass
from math import log2

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from panelkit.llm import common
from panelkit.sources.staging import stage

# The patterns of the contract. Group 2 of an assignment, or the whole match, must be so long.
ASSIGN = (
    r"([pP][aA][sS][sS][wW][oO][rR][dD]|[pP][aA][sS][sS][wW][dD]|[sS][eE][cC][rR][eE][tT]|[tT][oO][kK][eE][nN]|[aA][pP][iI]_?[kK][eE][yY])"
    r"[\x22']?\x20*[:=]\x20*[\x22']?([A-Za-z0-9+/_.=-]+)"
)
KINDS = {"assign": (ASSIGN, 2, 6), "access": (r"AKIA[A-Z0-9]+", 0, 20), "hex": (r"[0-9a-f]{24,}", 0, 24)}
#: What may be an encoded secret. Base64 padding belongs to it.
CANDIDATE = r"[A-Za-z0-9+/_-]{20,}={0,2}"

DIGITS, LOWER = "0123456789", "abcdefghijklmnopqrstuvwxyz"
UPPER = LOWER.upper()


@dataclass(frozen=True)
class Encoding:
    """An alphabet and the least departure that counts in it: excess of chi-squared per symbol, and of both other tests."""

    name: str
    alphabet: str
    uniformity: float
    order: float = 0.5

    @property
    def pattern(self) -> str:
        return "^[" + self.alphabet.replace("-", r"\-") + "]+={0,2}$"


#: In order of preference: the first that holds a string is its encoding.
ENCODINGS = (
    Encoding("hex", DIGITS + "abcdef", 0.5),
    Encoding("HEX", DIGITS + "ABCDEF", 0.5),
    Encoding("base32", UPPER + "234567", 0.8),
    Encoding("base36", DIGITS + LOWER, 0.9),
    Encoding("base62", UPPER + LOWER + DIGITS, 1.2),
    Encoding("base64", UPPER + LOWER + DIGITS + "+/", 1.2),
    Encoding("base64url", UPPER + LOWER + DIGITS + "-_", 1.2),
)
#: How far beyond chance, in standard deviations, a test must depart: chi-squared (whose tail is long), runs, correlation.
BEYOND = (6.0, 4.5, 4.0)

#: Letters, a digit and a separator; without case there are 28 kinds.
CLASSES = LOWER + UPPER + "0-"
#: Sevenths of a bit, from code 35 on, that a kind (column) costs after a kind (row). Counted in identifiers and words of
#: Python's library and in prose, with an addend for pairs not seen, for words that are joined, and for digits anywhere.
PAIRS = (
    r"GGABFQJOCZP?D8KHY>>6CMPRT[C?"
    r"<JDK9LNMBHQ4KL@HQGEFAQOPGQC?"
    r"=OJL=OQ5BWACMO6MUFI<ITSURXC?"
    r"?HIG3KPH:UTDNG:MUFBACRLRQUC?"
    r">OD?CMQOD^ZFJ9JJT77?OQPHVVC?"
    r">IGG>>KK7POBLK;KP@E@CONOLPC?"
    r">IHL2LIB@QODKCDKQB?AGMMOQNC?"
    r"5ILQ2RQEAXSHPE=NWED>MRLUWTC?"
    r"GK@H>MHRNZWDG1:IWH@:UNUQ[NC?"
    r":GEF=GGFDHFFGFCDHFDC@HHHHHC?"
    r"CIFG2HHH@KKDIFGGKFACHKEKJKC?"
    r">OKH1OSQ:WV=PO=MWOGBHTTU<WC?"
    r"8GLK2NPO>SQIGL=;SMEEFQPRMSC?"
    r"?KD;:L:IC[RJPG@MWJA6KNOXZYC?"
    r"IKDBJIMSHXRHD2HFY7CC;QKS[ZC?"
    r"8NIK9EOKCTR?OM?DR<F=HQPR>TC?"
    r"EHGHEHHHGJIGHGGGIFFC0IHIJJC?"
    r"<LIK1PJK>ZQJJG=MYB@>KPOWMWC?"
    r"EPBP9RQ=@WRKNNFHUM@/EVRVN[C?"
    r"@OJP3PV67^YLPMBM[ADBMWRXLPC?"
    r"DDGK8KKLEVT>C9FCS@A<PQQBVSC?"
    r":JIK0KLK;MMKJJGJNJHEKMKMLLC?"
    r">KHIAKL2:NNIJEBKO@DELMLLOOC?"
    r"@E;E=DLIALLHFIE@KGG:KKKGFLC?"
    r"DFDI=JLFCNNEE@B<NG>:HLFKLLC?"
    r"BGEG8HGHAJIFFHEGIGEC:IHGIHC?"
    r"RUSVPU_[Ydc[]ZYYd[WQ]b_Ted%:"
    r"@HAF<HLGC[VGGDBDWD@9HRLN_[8<"
)
#: Bits for the case of a letter after a lower and after an upper one: same, other. Share of steps in the model of steps.
AFTER_LOWER, AFTER_UPPER, STEADY = (-log2(0.9), -log2(0.1)), (-log2(0.6), -log2(0.4)), 0.8

#: Lower ends of the strata of length; the grid of p-values has so many steps for each power of ten.
STRATA, STEPS, LAST_STEP = (20, 32, 48, 96), 20, 400


@dataclass(frozen=True)
class Scan:
    rate: float = 0.05


def located(text: Column, pattern: str, found: Column) -> Column:
    """Begin and end, in code points, of matches that ``regexp_extract_all`` gave in order."""
    gaps = F.transform(F.split(text, pattern, -1), F.length)
    zipped = F.arrays_zip(F.slice(gaps, 1, F.size(found)).alias("gap"), F.transform(found, F.length).alias("size"))
    begin = F.struct(F.lit(0).alias("at"), F.expr("array()").cast("array<struct<start:int,end:int>>").alias("spans"))

    def step(seen: Column, one: Column) -> Column:
        start = seen["at"] + one["gap"]
        span = F.array(F.struct(start.alias("start"), (start + one["size"]).alias("end")))
        return F.struct((start + one["size"]).alias("at"), F.concat(seen["spans"], span).alias("spans"))

    return F.when(F.size(found) > 0, F.aggregate(zipped, begin, step)["spans"]).otherwise(begin["spans"])


def language_bits(token: Column) -> Column:
    """Minus the binary logarithm of the probability of a string as language, in one fold over its symbols."""
    plain = F.translate(F.rtrim(token, F.lit("=")), DIGITS[1:] + "+/_", "0" * 9 + "---")
    classes = F.transform(F.split(plain, ""), lambda c: F.call_function("instr", F.lit(CLASSES), c) - 1)
    kind = lambda y: F.when(y < 26, y).otherwise(y - 26)

    def step(t: Column, y: Column) -> Column:
        last = t["last"]
        pair = (F.ascii(F.substring(F.lit(PAIRS), kind(last) * 28 + kind(y) + 1, F.lit(1))) - 35) / 7
        lower = y < 26
        which = (
            F.when(y == 52, log2(10))
            .when(y == 53, 2.0)
            .when(last < 26, F.when(lower, AFTER_LOWER[0]).otherwise(AFTER_LOWER[1]))
            .when(last < 52, F.when(lower, AFTER_UPPER[1]).otherwise(AFTER_UPPER[0]))
            .otherwise(1.0)
        )
        return F.struct(y.alias("last"), (t["bits"] + pair + which).alias("bits"))

    # a string begins as after a separator
    return F.aggregate(classes, F.struct(F.lit(53).alias("last"), F.lit(0.0).alias("bits")), step, lambda t: t["bits"])


def p_value(token: Column, code: Encoding, language: Column) -> Column:
    """The p-value of not being random, from the bits as language; 1 where one of the three tests sees another structure."""
    a = len(code.alphabet)
    alphabet = F.lit(code.alphabet)
    symbols = F.transform(F.split(F.rtrim(token, F.lit("=")), ""), lambda c: F.call_function("instr", alphabet, c).cast("double") - 1)
    # bound to a variable, so that each is computed once
    mean = lambda x: F.aggregate(x, F.lit(0.0), lambda t, y: t + y) / F.size(x)
    return _let(symbols, lambda x: _let(mean(x), lambda m: _battery(x, m, a, code, language)))


def _let(value: Column, body) -> Column:
    return F.get(F.transform(F.array(value), body), F.lit(0))


def _battery(x: Column, mean: Column, a: int, code: Encoding, language: Column) -> Column:
    n = F.size(x).cast("double")
    ranks = F.sequence(F.lit(0), F.lit(a - 1))
    squares = F.aggregate(
        F.transform(ranks, lambda s: F.size(F.filter(x, lambda y: y == s)).cast("double")), F.lit(0.0), lambda t, c: t + c * c
    )
    excess = squares * a / n - n - (a - 1)

    zero = F.lit(0.0)
    start = F.struct(F.lit(-1.0).alias("last"), *[zero.alias(c) for c in ("runs", "upper", "cross", "square", "steps")])
    half = (a - 1) / 2

    def step(t: Column, y: Column) -> Column:
        first = t["last"] < 0
        fresh = first | ((t["last"] > half) != (y > half))
        d = y - mean
        return F.struct(
            y.alias("last"),
            (t["runs"] + fresh.cast("double")).alias("runs"),
            (t["upper"] + (y > half).cast("double")).alias("upper"),
            (t["cross"] + F.when(first, 0.0).otherwise((t["last"] - mean) * d)).alias("cross"),
            (t["square"] + d * d).alias("square"),
            (t["steps"] + (~first & (F.abs(y - t["last"]) <= 1)).cast("double")).alias("steps"),
        )

    def judge(t: Column) -> Column:
        upper, lower = t["upper"], n - t["upper"]
        both = 2 * upper * lower
        deviation = F.sqrt(F.greatest(both * (both - n), zero) / (n * n * (n - 1)))
        runs, serial = F.abs(t["runs"] - both / n - 1) / deviation, F.abs(t["cross"]) / t["square"] * F.sqrt(n)
        far = code.order * F.sqrt(n)
        departs = (excess > BEYOND[0] * (2 * (a - 1)) ** 0.5) & (excess > code.uniformity * n)
        # a string that keeps to one half, or to one symbol, departs as far as can be
        departs = departs | F.when(deviation > 0, (runs > BEYOND[1]) & (runs > far)).otherwise(True)
        departs = departs | F.when(t["square"] > 0, (serial > BEYOND[2]) & (serial > far)).otherwise(True)
        steady = log2(a) - t["steps"] * log2(STEADY / 3) - (n - 1 - t["steps"]) * log2((1 - STEADY) / (a - 3))
        ratio = F.pow(F.lit(2.0), F.least(n * log2(a) - F.least(language, steady), zero))
        return F.when(departs, 1.0).otherwise(ratio)

    return F.aggregate(x, start, step, judge)


def grid_step(p: Column) -> Column:
    """The step of a p-value, which stands for the largest p of that step; null without one, which ``greatest`` would skip."""
    step = F.least(F.floor(-F.log10(F.greatest(p, F.lit(1e-30))) * STEPS), F.lit(LAST_STEP)).cast("int")
    return F.when(p.isNotNull(), step)


def scanned(docs: DataFrame) -> DataFrame:
    """Documents with secret_base (kind, start, end in the order of the contract) and secret_more (candidates)."""
    rows = docs.withColumn("secret_text", common.text_of("text"))
    for kind, (pattern, _, _) in KINDS.items():
        rows = rows.withColumn(f"secret_{kind}", F.regexp_extract_all("secret_text", F.lit(pattern), F.lit(0)))
    bases = [_base(order, kind, *how) for order, (kind, how) in enumerate(KINDS.items())]
    rows = rows.withColumn("secret_base", F.array_sort(F.concat(*bases)))
    rows = rows.withColumn("secret_found", F.regexp_extract_all("secret_text", F.lit(CANDIDATE), F.lit(0)))
    spans = located(F.col("secret_text"), CANDIDATE, F.col("secret_found"))
    more = F.transform(F.arrays_zip(F.col("secret_found").alias("match"), spans.alias("span")), _candidate)
    outside = F.filter(more, lambda m: m["step"].isNotNull() & ~F.exists("secret_base", lambda b: (b["start"] < m["end"]) & (m["start"] < b["end"])))
    rows = rows.withColumn("secret_more", F.when(F.size("secret_found") > 0, outside).otherwise(F.slice(outside, 1, 0)))
    return rows.drop("secret_text", "secret_found", *[f"secret_{k}" for k in KINDS])


def _base(order: int, kind: str, pattern: str, group: int, least: int) -> Column:
    """The matches of one kind that are long enough."""
    found = F.col(f"secret_{kind}")
    both = F.arrays_zip(found.alias("match"), located(F.col("secret_text"), pattern, found).alias("span"))
    long_enough = F.filter(both, lambda m: F.length(F.regexp_extract(m["match"], pattern, group)) >= least)
    return F.transform(
        long_enough,
        lambda m: F.struct(m["span"]["start"].alias("start"), F.lit(order).alias("rank"), m["span"]["end"].alias("end"), F.lit(kind).alias("kind")),
    )


def _candidate(m: Column) -> Column:
    token = m["match"]

    def p_of(language: Column) -> Column:
        p = F.lit(None).cast("double")
        for code in reversed(ENCODINGS):
            p = F.when(token.rlike(code.pattern), p_value(token, code, language)).otherwise(p)
        return p

    p = _let(language_bits(token), p_of)
    bare = F.length(F.rtrim(token, F.lit("=")))
    stratum = F.lit(STRATA[0])
    for low in STRATA[1:]:
        stratum = F.when(bare >= low, low).otherwise(stratum)
    return F.struct(m["span"]["start"].alias("start"), m["span"]["end"].alias("end"), stratum.alias("stratum"), grid_step(p).alias("step"))


def thresholds(found: DataFrame, rate: float) -> Column:
    """A map from stratum to the first step that counts as a finding, as one value of the corpus."""
    each = found.select(F.explode("secret_more").alias("m")).groupBy("m.stratum", "m.step").agg(F.count("*").alias("n"))
    own = Window.partitionBy("stratum")
    at_least = F.sum("n").over(own.orderBy(F.desc("step")))
    largest_p = F.pow(F.lit(10.0), -F.col("step") / STEPS)
    kept = each.withColumn("findings", at_least).withColumn("m", F.sum("n").over(own)).filter(F.col("m") * largest_p <= rate * F.col("findings"))
    first = kept.groupBy("stratum").agg(F.min("step").alias("step"))
    return first.agg(F.map_from_entries(F.collect_list(F.struct("stratum", "step"))).alias("first")).scalar()


def all_spans(first: Column) -> Column:
    """Base spans and findings of a document, by start; ``first`` is the column of thresholds."""
    kept = F.filter("secret_more", lambda m: m["step"] >= F.try_element_at(first, m["stratum"]))
    random = F.transform(kept, lambda m: F.struct(m["start"].alias("start"), F.lit(len(KINDS)).alias("rank"), m["end"].alias("end"), F.lit("random").alias("kind")))
    return F.array_sort(F.concat("secret_base", random))


def _text(spans: Column) -> Column:
    return F.array_join(F.transform(spans, lambda s: F.concat_ws(":", s["kind"], s["start"].cast("string"), s["end"].cast("string"))), ",")


def _count(kind: str) -> Column:
    return F.size(F.filter("secret_base", lambda s: s["kind"] == kind)).cast("long").alias(f"n_{kind}")


def scan(docs: DataFrame, how: Scan = Scan()) -> DataFrame:
    """doc_id, counts per kind, digest of the base spans and all spans of every document."""
    found = stage(scanned(docs.select("doc_id", "text")).drop("text"), "secret-spans")
    counts = [_count(kind) for kind in KINDS]
    found = found.withColumn("secret_first", thresholds(found, how.rate))
    return found.select(
        "doc_id",
        *counts,
        F.sha2(_text(F.col("secret_base")), 256).alias("base_sha256"),
        _text(all_spans(F.col("secret_first"))).alias("spans"),
    )


def redact(docs: DataFrame, how: Scan = Scan(), mark: str = "[secret]") -> DataFrame:
    """The documents with every span replaced by a mark; their columns stay, n_chars follows the text.

    The corpus is scanned twice, for the thresholds and for the texts, so that no text is shuffled.
    """
    seen = stage(scanned(docs.select("text")).select("secret_more"), "secret-candidates")
    rows = scanned(docs.select(F.struct("*").alias("secret_row"), "text")).withColumn("secret_first", thresholds(seen, how.rate))
    rows = rows.withColumn("secret_spans", all_spans(F.col("secret_first")))
    start = F.struct(F.lit(0).alias("at"), F.expr("array()").cast("array<string>").alias("parts"))

    def step(t: Column, s: Column) -> Column:
        gap = F.substring("text", t["at"] + 1, s["start"] - t["at"])
        fresh = s["start"] >= t["at"]
        return F.struct(
            F.greatest(t["at"], s["end"]).alias("at"),
            F.when(fresh, F.concat(t["parts"], F.array(gap, F.lit(mark)))).otherwise(t["parts"]).alias("parts"),
        )

    done = F.aggregate("secret_spans", start, step, lambda t: F.concat(F.array_join(t["parts"], ""), F.substring("text", t["at"] + 1, F.lit(1 << 30))))
    found, row = F.size("secret_spans") > 0, F.col("secret_row")
    changed = row.withField("text", done)
    if "n_chars" in docs.columns:
        changed = changed.withField("n_chars", F.length(done).cast(docs.schema["n_chars"].dataType))
    return rows.select(F.when(found, changed).otherwise(row).alias("secret_row")).select("secret_row.*")


def op5(spark: SparkSession, sf_dir: str) -> DataFrame:
    return scan(common.table(spark, sf_dir, "documents"))
