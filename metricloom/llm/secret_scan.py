"""Secrets in texts: fixed patterns, and strings that are random and not natural.

A candidate is a run of 16 encoding characters or more. Its encoding is the smallest
alphabet that holds it. Two questions are asked of it.

Is it natural? Shorter runs, of all texts, give the frequency of each character after
each other one. If natural strings follow these, the ratio of the two likelihoods,
natural to uniform over the encoding, is a p-value for any length: a natural string has
a ratio of p or less with probability p at most. Within each length band, all candidates
of the corpus together decide which are reported (Benjamini-Hochberg): of the reported
strings, a share of ``false_discovery`` is natural at most, in expectation.

Is it regular? Of strings that may be reported, three tests ask whether they could be
uniform over the alphabet: chi-squared over equal cells (so many that each expects five
characters) and over digits against the rest, runs above and below the middle, and
lag-one serial correlation. The smallest of the p-values, times their number, is the
string's; within each encoding and length band, Benjamini-Hochberg again decides which
are too regular to be random.

Both decisions are made on a fixed grid of p-values, so on one small table of counts.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from metricloom.llm.columns import let, running_totals, total
from metricloom.llm.storage import stored

# The kinds of secrets with a known form, in order.
ASSIGN = (
    r"(?i)(password|passwd|secret|token|api_?key)[\"']?\x20*[:=]\x20*[\"']?"
    r"([A-Za-z0-9+/_.=-]+)"
)
ACCESS = r"AKIA[A-Z0-9]{16,}"
HEX = r"[0-9a-f]{24,}"
KINDS = ("assign", "access", "hex", "random")
ASSIGN_VALUE_LEAST = 6

LEAST_CHARACTERS = 16
CANDIDATE = rf"[A-Za-z0-9+/_-]{{{LEAST_CHARACTERS},}}"
FALSE_DISCOVERY = 0.05
# Grid of p-values: tenths of decades from 1 to 1e-30.
GRID_PER_DECADE, GRID_LAST = 10, 300
EXPECTED_PER_CELL = 5

DIGITS = "0123456789"
LOWER = "abcdefghijklmnopqrstuvwxyz"
ENCODINGS = {
    "hex": DIGITS + "abcdef",
    "hex_upper": DIGITS + "ABCDEF",
    "base32": LOWER.upper() + "234567",
    "base36": DIGITS + LOWER,
    "base36_upper": DIGITS + LOWER.upper(),
    "base62": DIGITS + LOWER.upper() + LOWER,
    "base64": LOWER.upper() + LOWER + DIGITS + "+/",
    "base64url": LOWER.upper() + LOWER + DIGITS + "-_",
    "mixed": LOWER.upper() + LOWER + DIGITS + "+/-_",
}
SYMBOLS = ENCODINGS["mixed"]
# What is natural before anything is counted: the share of characters of the kind of the
# one before them (lower case, capital, digit, sign), how many characters that weighs, and
# its share at least, however many are counted: joined words are rare among short runs.
SAME_KIND = 0.85
PRIOR_WEIGHT = 1000
PRIOR_SHARE = 0.2
# Longer words are cut into runs before they are counted.
LONGEST_WORD = 64
# The usual five-term approximation of the normal tail.
TAIL_T = 0.2316419
TAIL = (0.319381530, -0.356563782, 1.781477937, -1.821255978, 1.330274429)


def _located(text: Column, pattern: str) -> Column:
    """Matches as (start, end, found), from the lengths of what lies between and in them."""
    found = F.regexp_extract_all(text, F.lit(pattern), F.lit(0))

    def place(ms: Column) -> Column:
        ends = let(
            F.split(text, pattern, -1),
            lambda gaps: running_totals(
                F.transform(
                    ms, lambda m, i: (F.length(gaps[i]) + F.length(m)).cast("long")
                )
            ),
        )
        placed = let(
            ends,
            lambda e: F.transform(
                ms,
                lambda m, i: F.struct(
                    (e[i] - F.length(m)).alias("start"), e[i].alias("end"), m.alias("found")
                ),
            ),
        )
        none = F.array().cast("array<struct<start:bigint,end:bigint,found:string>>")
        return F.when(F.size(ms) > 0, placed).otherwise(none)

    return let(found, place)


def _tail(z: Column) -> Column:
    """Two-sided p-value of a standard normal."""

    def tail(a: Column) -> Column:
        t = 1 / (1 + TAIL_T * a)
        series = F.lit(0.0)
        for c in reversed(TAIL):
            series = (series + c) * t
        return F.least(
            F.lit(1.0), 2 * F.exp(-a * a / 2) / math.sqrt(2 * math.pi) * series
        )

    return let(F.least(F.abs(z), F.lit(38.0)), tail)


def _chi_squared(codes: Column, n: Column, size: int) -> Column:
    cells = F.greatest(
        F.lit(2), F.least(F.lit(size), F.floor(n / EXPECTED_PER_CELL))
    ).cast("int")

    def p(g: Column, cell: Column) -> Column:
        def part(c: Column) -> Column:
            expected = n * (F.ceil((c + 1) * size / g) - F.ceil(c * size / g)) / size
            seen = F.size(F.filter(cell, lambda x: x == c))
            return (seen - expected) * (seen - expected) / expected

        statistic = F.aggregate(
            F.transform(F.sequence(F.lit(0), g - 1), part), F.lit(0.0), lambda a, x: a + x
        )
        spread = 2 / (9 * (g - 1))
        return _tail((F.pow(statistic / (g - 1), F.lit(1 / 3)) - (1 - spread)) / F.sqrt(spread))

    return let(
        cells,
        lambda g: let(
            F.transform(codes, lambda x: F.floor(x * g / size).cast("int")),
            lambda cell: p(g, cell),
        ),
    )


def _digits(run: Column, n: Column, alphabet: str) -> Column:
    """Chi-squared over two cells: digits and the rest."""
    share = sum(c.isdigit() for c in alphabet) / len(alphabet)
    seen = F.length(F.regexp_replace(run, "[^0-9]", ""))
    return _tail((seen - n * share) / F.sqrt(n * share * (1 - share)))


def _runs(codes: Column, n: Column, size: int) -> Column:
    def p(high: Column) -> Column:
        ups = total(F.transform(high, lambda h: h.cast("long"))).cast("double")
        changes = F.size(
            F.filter(F.sequence(F.lit(1), n - 1), lambda i: high[i] != high[i - 1])
        )

        def score(product: Column) -> Column:
            spread = product * (product - n) / (n * n * (n - 1))
            return F.when(
                (product > 0) & (spread > 0),
                _tail((changes - product / n) / F.sqrt(spread)),
            ).otherwise(F.lit(0.0))

        return let(2 * ups * (n - ups), score)

    return let(F.transform(codes, lambda x: x >= size / 2), p)


def _serial(codes: Column, n: Column) -> Column:
    def p(mean: Column) -> Column:
        around = F.aggregate(
            codes, F.lit(0.0), lambda a, x: a + (x - mean) * (x - mean)
        )
        along = F.aggregate(
            F.sequence(F.lit(1), n - 1),
            F.lit(0.0),
            lambda a, i: a + (codes[i] - mean) * (codes[i - 1] - mean),
        )
        return let(
            around,
            lambda s: F.when(
                s > 0, _tail((along / s + 1 / n) * F.sqrt(n.cast("double")))
            ).otherwise(F.lit(0.0)),
        )

    return let(total(codes) / n, p)


def _encoding(run: Column) -> Column:
    kind = F.lit(None).cast("string")
    for name in reversed(ENCODINGS):
        held = ENCODINGS[name].replace("-", "") + "-" * ("-" in ENCODINGS[name])
        kind = F.when(run.rlike(f"^[{held}]+$"), F.lit(name)).otherwise(kind)
    return kind


def _p_value(run: Column, encoding: Column) -> Column:
    """The smallest of the tests' p-values times their number, at most 1."""
    out = F.lit(None).cast("double")
    for name, alphabet in ENCODINGS.items():
        out = F.when(encoding == name, _battery(run, alphabet)).otherwise(out)
    return out


def _battery(run: Column, alphabet: str) -> Column:
    def least(codes: Column) -> Column:
        n, size = F.size(codes), len(alphabet)
        tests = (
            _chi_squared(codes, n, size),
            _digits(run, n, alphabet),
            _runs(codes, n, size),
            _serial(codes, n),
        )
        return F.least(F.lit(1.0), len(tests) * F.least(*tests))

    codes = F.transform(
        F.split(run, ""), lambda c: (F.instr(F.lit(alphabet), c) - 1).cast("long")
    )
    return let(codes, least)


def _followers(run: Column) -> Column:
    """Per character, the number of the pair of it and the one before it."""
    codes = F.transform(F.split(run, ""), lambda c: F.instr(F.lit(SYMBOLS), c))
    return let(
        codes,
        lambda cs: F.transform(
            cs, lambda c, i: F.coalesce(F.get(cs, i - 1), F.lit(0)) * len(SYMBOLS) + c - 1
        ),
    )


def prior(before: str, after: str) -> float:
    """The chance of a character after another, or first (before is empty), by their kinds."""
    kinds = [LOWER, LOWER.upper(), DIGITS, SYMBOLS[62:]]
    [own] = [k for k in kinds if after in k]
    if not before:
        return 1 / len(kinds) / len(own)
    share = SAME_KIND if before in own else (1 - SAME_KIND) / (len(kinds) - 1)
    return share / len(own)


def natural_logs(docs: DataFrame) -> list[float]:
    """log2 of the chance of each character after each other, from all shorter runs.

    Words between spaces are counted first, long ones as the runs in them; then runs are
    cut from each distinct word and counted per pair of characters. 67 x 66 counts reach
    the driver, whatever the corpus.
    """

    def runs(word: str) -> Column:
        return F.split(word, "[^A-Za-z0-9+/_-]+")

    short = F.length("word") <= LONGEST_WORD
    rows = (
        docs.select(F.explode(F.split("text", " ")).alias("word"))
        .select(F.explode(F.when(short, F.array("word")).otherwise(runs("word"))).alias("word"))
        .where(F.length("word") <= LONGEST_WORD)
        .groupBy("word")
        .agg(F.count("*").alias("n"))
        .select(F.explode(runs("word")).alias("run"), "n")
        .where(F.length("run").between(1, LEAST_CHARACTERS - 1))
        .groupBy("run")
        .agg(F.sum("n").alias("n"))
        .select(F.explode(_followers(F.col("run"))).alias("pair"), "n")
        .groupBy("pair")
        .agg(F.sum("n").alias("n"))
        .collect()
    )
    counts = {r["pair"]: r["n"] for r in rows}
    logs = []
    for i, before in enumerate(["", *SYMBOLS]):
        first = i * len(SYMBOLS)
        n = sum(counts.get(first + j, 0) for j in range(len(SYMBOLS)))
        weight = max(PRIOR_WEIGHT, n * PRIOR_SHARE / (1 - PRIOR_SHARE))
        for j, after in enumerate(SYMBOLS):
            seen = counts.get(first + j, 0) + weight * prior(before, after)
            logs.append(math.log2(seen / (n + weight)))
    return logs


def _natural_p(run: Column, encoding: Column, logs: list[float]) -> Column:
    """The chance, at most, that a natural string is so much likelier as a uniform one."""
    table = F.split(F.lit(",".join(map(repr, logs))), ",").cast("array<double>")
    natural = F.aggregate(_followers(run), F.lit(0.0), lambda a, pair: a + F.get(table, pair))
    bits = F.coalesce(
        *[F.when(encoding == e, F.lit(math.log2(len(x)))) for e, x in ENCODINGS.items()]
    )
    return F.pow(F.lit(2.0), F.least(F.lit(0.0), natural + F.length(run) * bits))


def _candidates(text: Column, base: Column, logs: list[float], false_discovery: float) -> Column:
    """Runs that no known kind covers, with encoding, length band and p-values.

    The battery is only asked about what may be reported: no higher p-value than
    ``false_discovery`` ever is.
    """
    free = F.filter(
        _located(text, CANDIDATE),
        lambda c: ~F.exists(base, lambda b: (b["start"] < c["end"]) & (c["start"] < b["end"])),
    )

    def judged(c: Column) -> Column:
        return let(
            _encoding(c["found"]),
            lambda e: let(
                _natural_p(c["found"], e, logs),
                lambda natural: F.struct(
                    c["start"].alias("start"),
                    c["end"].alias("end"),
                    e.alias("encoding"),
                    F.floor(F.log2(F.length(c["found"]))).cast("int").alias("band"),
                    natural.alias("natural"),
                    F.when(natural <= false_discovery, _p_value(c["found"], e)).alias("p"),
                ),
            ),
        )

    return F.transform(free, judged)


def _bin(p: Column) -> Column:
    return F.least(
        F.lit(GRID_LAST),
        F.floor(-GRID_PER_DECADE * F.log10(F.greatest(p, F.lit(1e-300)))).cast("int"),
    )


def _found(docs: DataFrame, logs: list[float], false_discovery: float) -> DataFrame:
    """Adds base (known kinds) and candidates to the rows."""
    text = F.coalesce(F.col("text"), F.lit(""))

    def of(kind: str, pattern: str) -> Column:
        placed = _located(text, pattern)
        if kind == "assign":
            placed = F.filter(
                placed,
                lambda m: F.length(F.regexp_extract(m["found"], pattern, 2)) >= ASSIGN_VALUE_LEAST,
            )
        return F.transform(
            placed,
            lambda m: F.struct(
                m["start"].alias("start"),
                F.lit(KINDS.index(kind)).alias("rank"),
                m["end"].alias("end"),
            ),
        )

    base = F.concat(of("assign", ASSIGN), of("access", ACCESS), of("hex", HEX))
    return docs.withColumn("base", F.array_sort(base)).withColumn(
        "candidates", _candidates(text, F.col("base"), logs, false_discovery)
    )


def rejected(found: DataFrame, p: str, by: list[str], false_discovery: float) -> list:
    """Benjamini-Hochberg on one p-value: per group, the first grid bin that is rejected.

    One count per group and grid bin over all candidates that have the p-value; at most
    9 x 31 x 301 rows whatever the corpus, of which one per group reaches the driver.
    """
    counts = (
        found.select(F.explode("candidates").alias("c"))
        .where(F.col(f"c.{p}").isNotNull())
        .groupBy(*[F.col(f"c.{name}").alias(name) for name in by], _bin(F.col(f"c.{p}")).alias("bin"))
        .agg(F.count("*").alias("n"))
    )
    group = Window.partitionBy(*by)
    below = group.orderBy(F.desc("bin")).rowsBetween(Window.unboundedPreceding, 0)
    edge = F.pow(F.lit(10.0), -F.col("bin") / GRID_PER_DECADE)
    passed = (
        counts.withColumn("so_far", F.sum("n").over(below))
        .withColumn("all", F.sum("n").over(group))
        .where(F.col("all") * edge <= false_discovery * F.col("so_far"))
    )
    return passed.groupBy(*by).agg(F.min("bin").alias("bin")).collect()


def find_secrets(
    docs: DataFrame, false_discovery: float = FALSE_DISCOVERY, keep_text: bool = True
) -> DataFrame:
    """Per row of docs: its columns doc_id and text, and spans of (start, rank, end).

    `rank` is the place in KINDS; base has the known kinds, spans also the random
    strings. A null or empty text has no spans; a null doc_id and repeated rows
    stay rows of their own; other columns are left out, and the text too unless it is
    to be kept. Two scans: one counts characters of short runs, one writes what was
    found, which the decisions then read. Nothing else is shuffled but counts.
    """
    docs = docs.select("doc_id", "text")
    found = _found(docs, natural_logs(docs), false_discovery)
    found = stored(found if keep_text else found.drop("text"), "candidates")
    reported = rejected(found, "natural", ["band"], false_discovery)
    regular = rejected(found, "p", ["encoding", "band"], false_discovery)

    def is_random(c: Column) -> Column:
        out = F.lit(False)
        for r in reported:
            out = out | ((c["band"] == r["band"]) & (_bin(c["natural"]) >= r["bin"]))
        for r in regular:
            out = out & ~(
                (c["encoding"] == r["encoding"])
                & (c["band"] == r["band"])
                & (_bin(c["p"]) >= r["bin"])
            )
        return out

    spans = F.transform(
        F.filter("candidates", is_random),
        lambda c: F.struct(
            c["start"].alias("start"), F.lit(KINDS.index("random")).alias("rank"), c["end"].alias("end")
        ),
    )
    kept = ["doc_id", "text"] if keep_text else ["doc_id"]
    return found.select(*kept, "base", F.array_sort(F.concat("base", spans)).alias("spans"))


def written(spans: Column) -> Column:
    """kind:start:end, comma-joined."""
    names = F.array(*[F.lit(k) for k in KINDS])
    return F.array_join(
        F.transform(
            spans,
            lambda s: F.concat_ws(
                ":", names[s["rank"]], s["start"].cast("string"), s["end"].cast("string")
            ),
        ),
        ",",
    )


def secret_report(docs: DataFrame) -> DataFrame:
    def n(kind: str) -> Column:
        rank = KINDS.index(kind)
        return F.size(F.filter("base", lambda s: s["rank"] == rank)).cast("long").alias(f"n_{kind}")

    return find_secrets(docs, keep_text=False).select(
        "doc_id",
        n("assign"),
        n("access"),
        n("hex"),
        F.sha2(written(F.col("base")), 256).alias("base_sha256"),
        written(F.col("spans")).alias("spans"),
    )
