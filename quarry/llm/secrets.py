"""Secret scan: fixed patterns, and a battery of randomness tests with false-discovery control.

All work is DataFrame expressions.  Matches of a pattern are found by splitting the text at them:
the lengths of the gaps and of the matches add up to code-point positions.

The battery looks at every run of 20 or more signs of the base-64 families, and at its parts between
"/", "-" and "_", as keys stand in paths and behind names.  A run's encoding is inferred (hex, base 32,
36, 62, 64, URL-safe 64), which gives an alphabet of A signs:

* chi-squared uniformity over the alphabet, as the number of equal pairs of signs;
* runs test above and below the middle of the alphabet;
* lag-one serial correlation of the places in the alphabet.

The null hypothesis "text" is a Markov chain: letters, digits and other signs (upper and lower case
apart where the alphabet has both) follow each other as in words and identifiers, and a letter follows
a letter as in English.  Its p-value is the likelihood ratio of text to uniform signs, at most 1; by
Markov's inequality text gets a ratio of p or less with probability p at most.

A run counts as a secret if the text hypothesis is rejected under Benjamini-Hochberg control over
all runs of the corpus, within length classes, and if none of the three tests rejects uniform randomness.
Of a run and its parts the widest that pass are kept.
"""

from __future__ import annotations

import math
from string import ascii_lowercase, ascii_uppercase, digits

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

#: The patterns of the base kinds and the least length of what they must hold.
ASSIGN = (r"(?i:(password|passwd|secret|token|api_?key))[\"']?\x20*[:=]\x20*[\"']?([A-Za-z0-9+/_.=-]+)", 6)
ACCESS = (r"AKIA[A-Z0-9]+", 20)
HEX = (r"[0-9a-f]{24,}", 24)
#: Runs of the signs of base 64, of URL-safe 64, and of neither's "/", "-" and "_"; "=" ends a run and
#: belongs to it only as padding.  RUN_SIGNS is the least length with padding.
RUN_SIGNS = 20
RUNS = tuple(rf"[{c}]{{16,}}(?:=++(?![A-Za-z0-9+/_-]))?" for c in ("A-Za-z0-9+/", "A-Za-z0-9_-", "A-Za-z0-9+"))
KINDS = ("assign", "access", "hex", "random")

_B64 = ascii_uppercase + ascii_lowercase + digits

#: (name, pattern a run must fit, alphabet)
ENCODINGS = (
    ("hex", r"^(?=.*[0-9])(?=.*[a-f])[0-9a-f]+$", digits + "abcdef"),
    ("hex", r"^(?=.*[0-9])(?=.*[A-F])[0-9A-F]+$", digits + "ABCDEF"),
    ("base32", r"^(?=.*[2-7])(?=.*[A-Z])[A-Z2-7]+=*$", ascii_uppercase + "234567"),
    ("base36", r"^(?=.*[0-9])(?=.*[a-z])[a-z0-9]+$", digits + ascii_lowercase),
    ("base36", r"^(?=.*[0-9])(?=.*[A-Z])[A-Z0-9]+$", digits + ascii_uppercase),
    ("base62", r"^(?=.*[a-z])(?=.*[A-Z])[A-Za-z0-9]+$", _B64),
    ("base64", r"^(?=.*[a-z])(?=.*[A-Z])[A-Za-z0-9+/]+=*$", _B64 + "+/"),
    ("base64url", r"^(?=.*[a-z])(?=.*[A-Z])[A-Za-z0-9_-]+=*$", _B64 + "-_"),
)
#: Letter after letter, a row for each first letter: "a" to "k" stand for probabilities exp(0) to exp(-5)
#: in steps of exp(-0.5).  Counted on the words of Python's standard library, 15 % spread evenly.
BIGRAMS = (
    "khggkjhkgkjeffkhkefeiijjik fjhidkkkgekfkjgikhhjfkkkfj fkikekkfhkffjkdjkhiehkkkkk fjjgcjkkekkikjfkkhgigkkkjk "
    "gjgghgjkjkkehfjhjeffkijgik fkjigfkkdkkgjjdjkfhhgkkkjk hkjkckihfkkgjfhjkgeifjkkkj ekkkckkkfkkjjjfkkhjhikkkkk "
    "iighifhkkkkggdfikhefkikjki hkhkbkkkikikkkeikkjkekkkkk gkiicjikfkkgkhiikifjhkfkkk fjjhdekkekkgkjfjkkgggkkkhk "
    "egkjckkkgkkjhkfekkhihkkkkk fkgeeifkhkiikiejkkgehikkjk jhhfjgjkikjhgdigkdgfgihkkk ekjiejkjgkkfkkfgkeifhjkkhk "
    "kkkjkkkkkkkjkijjkhijbkkkkk fkiidjgkfkjjhffjkggghjjkhk hkikckjhfkjijjhhkjfdgkjkik fijkejkdekkijkfjkfghfkjkhk "
    "ihijfhjkhkkffejgkdffkkkkkk ckkkckkkfkkkjjikkkkkkkkkkk ekkiejkedkkikgfkkehjkkjkkk gjdjfikjfkkijkjfkjfjickkijk"
    " jjijfjjjgkkihghdkieejjhkjk hkkkbkkiekkiijhkkjjkkkkkjk").split()
#: Kind of sign after kind of sign in text: other signs, digits, upper and lower case; letters and digits
#: where all letters have one case; the same in hex.
_MIXED = {"o": dict(o=.05, d=.18, u=.27, l=.50), "d": dict(o=.08, d=.70, u=.10, l=.12),
          "u": dict(o=.05, d=.05, u=.28, l=.62), "l": dict(o=.05, d=.04, u=.08, l=.83)}
_SINGLE = {"d": dict(d=.80, l=.20), "l": dict(d=.10, l=.90)}
_HEX = {"d": dict(d=.97, l=.03), "l": dict(d=.10, l=.90)}
RATE = 0.01        # false-discovery rate
BATTERY = 0.001    # level of the three tests of uniform randomness together
LENGTH_CLASSES = (32, 48, 80)
BINS_PER_DECADE = 20
LAST_BIN = 800     # p-values below 1e-40 share the last bin
CHUNK = 256


# ---------------------------------------------------------------- text


def _ratios(alphabet: str) -> list[int]:
    """100 ln(probability in text / probability among uniform signs) of every sign after every sign."""
    mixed, size = alphabet.lower() != alphabet and alphabet.upper() != alphabet, len(alphabet)
    chain = _MIXED if mixed else _HEX if size == 16 else _SINGLE
    kind = lambda c: "d" if c.isdigit() else "o" if not c.isalpha() else "u" if mixed and c.isupper() else "l"
    out = []
    for p in alphabet:
        weight = {}
        for q in alphabet:
            both = p.isalpha() and q.isalpha() and size > 16
            weight[q] = math.exp((ord("a") - ord(BIGRAMS[ord(p.lower()) - 97][ord(q.lower()) - 97])) / 2) if both else 1.0
        whole: dict[str, float] = {}
        for q, w in weight.items():
            whole[kind(q)] = whole.get(kind(q), 0.0) + w
        rest = sum(chain[kind(p)][k] for k in whole)
        out += [round(100 * math.log(chain[kind(p)][kind(q)] / rest * weight[q] / whole[kind(q)] * size)) for q in alphabet]
    return out


def _tables() -> tuple[list[int], dict[str, int]]:
    """The ratios of all alphabets one after the other, and where those of each start."""
    table, start = [], {}
    for _, _, alphabet in ENCODINGS:
        if alphabet not in start:
            start[alphabet] = len(table)
            table += _ratios(alphabet)
    return table, start


# ---------------------------------------------------------------- positions


def _running_sums(df: DataFrame, name: str, values: str) -> DataFrame:
    """Adds the running sums of an array column, chunk by chunk, so the work stays near linear.

    The chunk starts are a column of their own, read twice below: Spark then computes it once a
    row instead of once an element.
    """
    add = lambda a, x: a + x
    zero, v = F.lit(0).cast("long"), F.col(values)
    chunks = F.transform(F.sequence(F.lit(0), F.floor((F.size(v) - 1) / CHUNK).cast("int")),
                         lambda c: F.aggregate(F.slice(v, c * CHUNK + 1, F.lit(CHUNK)), zero, add))
    starts = F.aggregate(chunks, F.array(zero), lambda a, x: F.concat(a, F.array(F.element_at(a, -1) + x)))

    def one(x, i):
        c = F.floor(i / CHUNK).cast("int")
        return F.element_at("_starts", c + 1) + F.aggregate(
            F.slice(v, c * CHUNK + 1, (i - c * CHUNK + 1).cast("int")), zero, add)

    df = df.withColumn("_starts", F.when(F.size(v) > 0, starts))
    return df.withColumn(name, F.when(F.size("_starts") > 0, F.transform(v, one))).drop("_starts")


_SPAN = "array<struct<start: bigint, rank: int, end: bigint>>"


def _find(df: DataFrame, name: str, pattern: str, rank: int, group: int = 0, least: int = 0) -> DataFrame:
    """Adds an array column of the spans of a pattern's leftmost matches, in code points.

    Only matches whose ``group`` has ``least`` code points are kept; all of them count for positions.
    """
    text, none = F.col("text"), F.expr("array()")
    there = text.rlike(pattern)
    df = df.withColumn("_hits", F.when(there, F.transform(F.regexp_extract_all("text", F.lit(pattern), F.lit(0)),
                                                          lambda h: F.length(h).cast("long"))))
    df = df.withColumn("_held", F.col("_hits") if not group else F.when(
        F.col("_hits").isNotNull(), F.transform(F.regexp_extract_all("text", F.lit(pattern), F.lit(group)),
                                                lambda h: F.length(h).cast("long"))))
    df = df.withColumn("_steps", F.when(F.col("_hits").isNotNull(), F.zip_with(
        F.slice(F.split("text", pattern, -1), F.lit(1), F.size("_hits")), "_hits", lambda g, h: F.length(g) + h)))
    df = _running_sums(df, "_ends", "_steps")
    spans = F.transform(F.arrays_zip("_ends", "_hits", "_held"), lambda x: F.struct(
        (x["_ends"] - x["_hits"]).alias("start"), F.lit(rank).alias("rank"), x["_ends"].alias("end"),
        (x["_held"] >= least).alias("ok")))
    kept = F.transform(F.filter(spans, lambda s: s["ok"]), lambda s: F.struct(s["start"], s["rank"], s["end"]))
    return df.withColumn(name, F.coalesce(kept, none.cast(_SPAN))).drop("_hits", "_held", "_steps", "_ends")


# ---------------------------------------------------------------- battery


def _upper(z: Column) -> Column:
    """Upper tail of the standard normal distribution (rational approximation, error below 1e-7)."""
    a = F.least(F.abs(z), F.lit(38.0))
    t = 1 / (1 + 0.2316419 * a)
    poly = t * (0.319381530 + t * (-0.356563782 + t * (1.781477937 + t * (-1.821255978 + t * 1.330274429))))
    tail = F.exp(-a * a / 2) / math.sqrt(2 * math.pi) * poly
    return F.when(z >= 0, tail).otherwise(1 - tail)


def _choose(body: Column, what) -> Column:
    out = None
    for _, pattern, alphabet in ENCODINGS:
        value = F.lit(what(alphabet))
        out = F.when(body.rlike(pattern), value) if out is None else out.when(body.rlike(pattern), value)
    return out


def _battery(df: DataFrame) -> DataFrame:
    """Adds ``tested``: for every run with an inferred encoding its span and p-values."""
    numbers, starts = _tables()
    # one literal, which Spark folds to a constant array
    table = F.split(F.lit(",".join(map(str, numbers))), ",").cast("array<int>")
    names = []
    for k, pattern in enumerate(RUNS):
        names.append(f"_run_spans{k}")
        df = _find(df, names[-1], pattern, 3, 0, RUN_SIGNS)
        runs = F.filter(F.regexp_extract_all("text", F.lit(pattern), F.lit(0)), lambda r: F.length(r) >= RUN_SIGNS)
        df = df.withColumn(names[-1], F.when(F.size(names[-1]) > 0, F.zip_with(
            names[-1], runs, lambda s, r: F.struct(s.alias("span"), r.alias("run")))).otherwise(
            F.expr("array()").cast(f"array<struct<span: {_SPAN[6:-1]}, run: string>>")))
    # sorted, equal ones stand side by side; array_distinct compares all pairs of structs
    df = df.withColumn("_runs", F.array_sort(F.concat(*names)))
    single = F.filter("_runs", lambda x, i: (i == 0) | (F.element_at("_runs", F.greatest(i, F.lit(1))) != x))
    stage = F.transform(single, lambda x: F.struct(
        x["span"], F.regexp_replace(x["run"], "=+$", "").alias("body"),
        _choose(x["run"], lambda a: a).alias("alphabet"), _choose(x["run"], lambda a: starts[a]).alias("base")))
    stage = F.filter(stage, lambda x: x["alphabet"].isNotNull() & (F.length(x["body"]) >= 16))
    stage = F.transform(stage, lambda x: F.struct(
        x["span"], x["body"], x["base"], F.length(x["alphabet"]).cast("double").alias("a"),
        F.length(x["body"]).cast("double").alias("n"),
        F.transform(F.regexp_extract_all(x["body"], F.lit("."), F.lit(0)),
                    lambda c: F.instr(x["alphabet"], c).cast("double")).alias("v")))
    zero = F.lit(0.0)
    add = lambda acc, y: acc + y
    # the mean is a field of its own: inside the sums below it would be computed for every sign
    stage = F.transform(stage, lambda x: F.struct(
        x["span"], x["body"], x["base"], x["a"], x["n"], x["v"], (F.aggregate(x["v"], zero, add) / x["n"]).alias("mean")))

    def sums(x):
        n, v = x["n"], x["v"]
        high = lambda y: (y > x["a"] / 2).cast("double")
        mean = x["mean"]
        pairs = lambda f: F.aggregate(F.zip_with(
            F.slice(v, F.lit(1), (n - 1).cast("int")), F.slice(v, F.lit(2), (n - 1).cast("int")), f), zero, add)
        squares = F.aggregate(F.array_distinct(F.regexp_extract_all(x["body"], F.lit("."), F.lit(0))), zero,
                              lambda acc, c: acc + F.pow(n - F.length(F.replace(x["body"], c, F.lit(""))), 2))
        return F.struct(
            x["span"], n.alias("n"), x["a"], squares.alias("squares"),
            pairs(lambda p, q: F.element_at(table, (x["base"] + (p - 1) * x["a"] + q).cast("int")).cast("double"))
            .alias("text"),
            F.aggregate(v, zero, lambda acc, y: acc + high(y)).alias("n1"),
            (1 + pairs(lambda p, q: (high(p) != high(q)).cast("double"))).alias("runs"),
            pairs(lambda p, q: (p - mean) * (q - mean)).alias("cross"),
            F.aggregate(v, zero, lambda acc, y: acc + (y - mean) * (y - mean)).alias("spread"))

    def values(x):
        n, a = x["n"], x["a"]
        chi = a / n * x["squares"] - n
        uneven = _upper((chi - (a - 1)) / F.sqrt(2 * (a - 1) * (n - 1) / n))
        both = 2 * x["n1"] * (n - x["n1"])
        runs = F.when((both > n), 2 * _upper(F.abs(x["runs"] - both / n - 1) / F.sqrt(
            F.greatest(both * (both - n) / (n * n * (n - 1)), F.lit(1e-12))))).otherwise(zero)
        serial = F.when(x["spread"] > 0, 2 * _upper(F.abs(
            x["cross"] / F.greatest(x["spread"], F.lit(1e-12)) * F.sqrt(n) + 1 / F.sqrt(n)))).otherwise(zero)
        family = F.lit(0)
        for limit in LENGTH_CLASSES:
            family = family + (n >= limit).cast("int")
        decades = F.greatest(-x["text"] / (100 * math.log(10)), F.lit(0.0))
        return F.struct(x["span"], family.alias("family"),
                        F.least(F.floor(decades * BINS_PER_DECADE), F.lit(LAST_BIN)).cast("int").alias("bin"),
                        (F.least(uneven, runs, serial) >= BATTERY / 3).alias("random"))

    stage = F.transform(F.transform(stage, sums), values)
    return df.withColumn("tested", F.coalesce(stage, F.expr("array()").cast(
        "array<struct<span: struct<start: bigint, rank: int, end: bigint>, family: int, bin: int, random: boolean>>"
    ))).drop(*names, "_runs")


def _thresholds(df: DataFrame, rate: float) -> dict[int, int]:
    """For every length class the least p-value bin that Benjamini-Hochberg control rejects.

    One count per class and bin reaches the driver, ``(LAST_BIN + 1) * 4`` numbers at most.
    """
    counts: dict[int, dict[int, int]] = {}
    # explode_outer: for explode, Spark adds a filter that computes the whole battery once more
    runs = df.select(F.explode_outer("tested").alias("t")).filter("t IS NOT NULL")
    for r in runs.groupBy("t.family", "t.bin").count().collect():
        counts.setdefault(r["family"], {})[r["bin"]] = r["count"]
    out = {}
    for family, bins in counts.items():
        total, seen = sum(bins.values()), 0
        for b in sorted(bins, reverse=True):  # smallest p-values first
            seen += bins[b]
            if 10 ** (-b / BINS_PER_DECADE) * total <= rate * seen:  # the bin's largest p-value
                out[family] = b
    return out


# ---------------------------------------------------------------- operator


def find_secrets(docs: DataFrame, rate: float = RATE) -> DataFrame:
    """All columns of ``docs`` and ``base``, ``found``: arrays of (start, rank, end).

    Spans are in code points, end exclusive, ordered by start and kind; ``rank`` is the place in
    :data:`KINDS`.  ``base`` holds the leftmost non-overlapping matches of each fixed pattern, a
    match that is too short being dropped.  ``found`` are those and the runs that pass the
    battery and overlap no base span.  Null text counts as empty.  Statistics are over all rows;
    each row is judged on its own, so repeated rows give repeated results.  Column names starting
    with an underscore, ``base`` and ``found`` are taken.
    """
    rows = docs.withColumn("text", F.coalesce(F.col("text").cast("string"), F.lit("")))
    least = _thresholds(_battery(rows.select("text")), rate)
    rows = _battery(rows)
    rows = _find(rows, "_assign", ASSIGN[0], 0, 2, ASSIGN[1])
    rows = _find(rows, "_access", ACCESS[0], 1, 0, ACCESS[1])
    rows = _find(rows, "_hex", HEX[0], 2, 0, HEX[1])
    rows = rows.withColumn("base", F.array_sort(F.concat("_assign", "_access", "_hex")))
    passed = lambda t: F.lit(False)
    for family, b in least.items():
        passed = (lambda before, f, b: lambda t: before(t) | ((t["family"] == f) & (t["bin"] >= b)))(passed, family, b)
    more = F.transform(F.filter("tested", lambda t: t["random"] & passed(t) & ~F.exists(
        "base", lambda s: (s["start"] < t["span"]["end"]) & (t["span"]["start"] < s["end"]))), lambda t: t["span"])
    order = F.transform(F.array_sort(F.transform(more, lambda s: F.struct(s["start"], (-s["end"]).alias("back"), s.alias("s")))),
                        lambda x: x["s"])
    first = F.struct(F.lit(0).cast("long").alias("end"), F.expr("array()").cast(_SPAN).alias("kept"))
    widest = F.aggregate(order, first, lambda acc, s: F.struct(
        F.greatest(acc["end"], s["end"]).alias("end"),
        F.when(s["end"] > acc["end"], F.concat(acc["kept"], F.array(s))).otherwise(acc["kept"]).alias("kept")),
        lambda acc: acc["kept"])
    rows = rows.withColumn("found", F.array_sort(F.concat("base", widest)))
    return rows.drop("tested", "_assign", "_access", "_hex")


def _joined(spans: str) -> Column:
    kinds = F.array(*[F.lit(k) for k in KINDS])
    return F.array_join(F.transform(spans, lambda s: F.concat_ws(
        ":", F.element_at(kinds, s["rank"] + 1), s["start"].cast("string"), s["end"].cast("string"))), ",")


def secret_digest(docs: DataFrame, rate: float = RATE) -> DataFrame:
    """doc_id, n_assign, n_access, n_hex, base_sha256, spans of every row (see :func:`find_secrets`)."""
    rows = find_secrets(docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text"), rate)
    count = lambda k: F.size(F.filter("base", lambda s: s["rank"] == k)).cast("long")
    return rows.select("doc_id", count(0).alias("n_assign"), count(1).alias("n_access"), count(2).alias("n_hex"),
                       F.sha2(_joined("base").cast("binary"), 256).alias("base_sha256"),
                       _joined("found").alias("spans"))


def redact(docs: DataFrame, mark: str = "[SECRET]", rate: float = RATE) -> DataFrame:
    """The rows of ``docs`` with every found span in ``text`` replaced by ``mark``.

    Overlapping spans share one mark.  ``n_chars``, where there is one, follows the new text.  Rows
    without finds, and null texts, stay as they are; so do all other columns, whatever their names.
    """
    rows = find_secrets(docs.select(F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("row"), "text"), rate)
    own = lambda c: F.col("row").getField(c)
    start = F.struct(F.lit(0).cast("long").alias("at"), F.lit("").alias("out"))
    text = F.col("text")

    def step(acc, s):
        gap = F.substring(text, (acc["at"] + 1).cast("int"), F.greatest(s["start"] - acc["at"], F.lit(0)).cast("int"))
        opened = (s["start"] >= acc["at"]) | (acc["at"] == 0)
        return F.struct(F.greatest(acc["at"], s["end"]).alias("at"), F.when(opened, F.concat(
            acc["out"], gap, F.lit(mark))).otherwise(acc["out"]).alias("out"))

    done = F.aggregate("found", start, step, lambda acc: F.concat(
        acc["out"], F.substring(text, (acc["at"] + 1).cast("int"), F.length(text))))
    hit = F.size("found") > 0
    rows = rows.withColumn("text", F.when(hit, done).otherwise(own("text")))
    columns = {c: own(c) for c in docs.columns}
    columns["text"] = F.col("text")
    if "n_chars" in docs.columns:
        columns["n_chars"] = F.when(hit, F.length("text").cast(docs.schema["n_chars"].dataType)).otherwise(own("n_chars"))
    return rows.select(*[value.alias(c) for c, value in columns.items()])
