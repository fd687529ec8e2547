"""Secret scan in DataFrame expressions only: fixed patterns plus sliding-window entropy.

Three base kinds are matched leftmost and without overlap inside a kind; matches that fail their
length test are dropped after matching. The entropy kind slides a window over candidate strings
and keeps the Shannon entropy of the window by incremental counts: each step subtracts the term
of the leaving character and adds the term of the entering one. Runs of letters and digits inside
a candidate are judged besides, each class of characters by a limit of its own.

Defined results: a null text counts as empty; an empty text has no spans; repeated rows are judged
each on its own; very long texts are scanned whole; ties at one start are ordered by kind as listed
and then by end; an empty table gives an empty table; further columns are carried along untouched
unless they bear the name of a result column, which then replaces them.
"""

from __future__ import annotations

import math
import re
from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def _either_case(word: str) -> str:
    return "".join(f"[{c.upper()}{c}]" if c.isalpha() else c for c in word)


_NAMES = "|".join([*map(_either_case, ("password", "passwd", "secret", "token")), _either_case("api") + "_?" + _either_case("key")])
ASSIGN = rf"""({_NAMES})["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)"""
ACCESS = r"AKIA[A-Z0-9]+"
#: Runs below 24 characters fail anyway, so only the long ones are asked for; same matches.
HEX = r"[0-9a-f]{24,}"
CANDIDATE = r"[A-Za-z0-9+/_=-]{20,}"
KINDS = ("assign", "access", "hex", "entropy")
WINDOW = 20
#: Candidates hold characters from the plus sign to the small z.
FIRST_CODE, LAST_CODE = 43, 122
#: (test a candidate must pass, bits of entropy a window of it must reach), by character class.
CLASSES = {"hex": (r"^(?=.*[0-9])(?=.*[A-Fa-f])[0-9A-Fa-f]+$", 3.0), "mixed": (r"^(?=.*[0-9])(?=.*[a-z])(?=.*[A-Z]).*$", 3.6)}
#: Letters and digits without the marks that glue names, values and words to each other.
RUN = r"[A-Za-z0-9]{20,}"
#: Further classes of runs, after those above; prose and digits alone stay below these limits.
RUN_CLASSES = {"lower": (r"^(?=.*[0-9])(?=.*[a-z])[0-9a-z]+$", 3.5), "upper": (r"^(?=.*[0-9])(?=.*[A-Z])[0-9A-Z]+$", 3.5), "letters": (r"^[A-Za-z]+$", 3.9)}
#: Well-known harmless strings (UUIDs, examples, runs of the alphabet or of digits) with their lengths; a
#: hot span is harmless if they leave less than a window of it.
HARMLESS = (
    ("wJalrXUtnFEMI/K7MDENG/bPxRfiCYEXAMPLEKEY", 40), ("[0-9A-Fa-f]{8}-[0-9A-Fa-f]{4}-[0-9A-Fa-f]{4}-[0-9A-Fa-f]{4}-[0-9A-Fa-f]{12}", 36),
    ("abcdefghijklmnopqrstuvwxyz|ABCDEFGHIJKLMNOPQRSTUVWXYZ", 26), ("abcdefghij|ABCDEFGHIJ|0123456789|1234567890", 10), ("EXAMPLE|[Ee]xample", 7),
)
SPAN = "array<struct<start:bigint,kind:int,end:bigint>>"


def _let(value: Column, body: Callable[[Column], Column]) -> Column:
    """``body`` of a value that is computed once, however often the body speaks of it."""
    return F.get(F.transform(F.array(value), body), F.lit(0))


def _scanned(items: Column, zero: Column, add: Callable[[Column, Column], Column], out: Callable[[Column, Column], Column], kind: str) -> Column:
    """``out(state, item)`` of every item, where the state folds all earlier items by ``add``.

    Spark has no running fold over an array, and appending to one copies it. So items are walked in
    blocks of about the square root of their number, and only a block's results are appended.
    """

    def blocked(items: Column) -> Column:
        width = F.ceil(F.sqrt(F.size(items))).cast("int")
        blocks = F.transform(F.sequence(F.lit(0), F.greatest(F.ceil(F.size(items) / F.greatest(width, F.lit(1))).cast("int") - 1, F.lit(0))), lambda k: F.slice(items, k * width + 1, F.greatest(width, F.lit(1))))
        begun = lambda acc, block: F.struct(
            F.aggregate(block, acc["state"], add).alias("state"), F.concat(acc["blocks"], F.array(F.struct(acc["state"].alias("state"), block.alias("items")))).alias("blocks"))
        start = F.struct(zero.alias("state"), F.slice(F.array(F.struct(zero.alias("state"), items.alias("items"))), 1, 0).alias("blocks"))
        none = F.array().cast(f"array<{kind}>")
        inside = lambda block: F.aggregate(
            block["items"], F.struct(block["state"].alias("state"), none.alias("out")),
            lambda acc, x: F.struct(add(acc["state"], x).alias("state"), F.concat(acc["out"], F.array(out(acc["state"], x))).alias("out")), lambda acc: acc["out"])
        return F.flatten(F.transform(F.aggregate(blocks, start, begun, lambda acc: acc["blocks"]), inside))

    return _let(items, lambda x: F.when(F.size(x) > 0, blocked(x)).otherwise(F.array().cast(f"array<{kind}>")))


_PIECE = "struct<start:bigint,size:bigint,value:string>"


def _pieces(text: Column, pattern: str, size_group: int) -> Column:
    """``array<struct<start,size,value>>`` of every match; starts count code points from 0."""
    found, gaps = F.regexp_extract_all(text, F.lit(pattern), F.lit(0)), F.split(text, pattern, -1)
    sizes = F.regexp_extract_all(text, F.lit(pattern), F.lit(size_group))
    measured = F.transform(F.arrays_zip(found.alias("value"), gaps.alias("gap"), sizes.alias("sized")), lambda x: F.struct(x["value"].alias("value"), F.length(x["gap"]).cast("bigint").alias("gap"), F.length(x["value"]).cast("bigint").alias("long"), F.length(x["sized"]).cast("bigint").alias("size")))
    # the last gap has no match behind it
    joined = F.filter(measured, lambda x: x["value"].isNotNull())
    piece = lambda at, x: F.struct((at + x["gap"]).alias("start"), x["size"].alias("size"), x["value"].alias("value"))
    starts = _scanned(joined, F.lit(0).cast("bigint"), lambda at, x: at + x["gap"] + x["long"], piece, _PIECE)
    return F.when(text.rlike(pattern), starts).otherwise(F.array().cast(f"array<{_PIECE}>"))


def _base(text: Column, kind: int, pattern: str, group: int, least: int) -> Column:
    kept = F.filter(_pieces(text, pattern, group), lambda m: m["size"] >= least)
    return F.transform(kept, lambda m: F.struct(m["start"].alias("start"), F.lit(kind).alias("kind"), (m["start"] + F.length(m["value"])).cast("bigint").alias("end"))).cast(SPAN)


def _term(count: Column) -> Column:
    return F.when(count <= 1, F.lit(0.0)).otherwise(count * F.log2(F.greatest(count, F.lit(1)).cast("double")))


def _hot_range(value: Column, bits: Column) -> Column:
    """First and last window end (index of its last character) whose entropy reaches ``bits``.

    The fold carries how often each character is in the window, and the sum of the terms of these
    counts; a step changes both by the character that leaves and the one that enters.
    """

    def step(codes: Column) -> Callable[[Column, Column], Column]:
        def run(acc: Column, i: Column) -> Column:
            entering, leaving = F.get(codes, i), F.coalesce(F.get(codes, i - WINDOW), F.lit(-1))
            gone, same = F.get(acc["counts"], leaving), (entering == leaving).cast("int")
            had = F.get(acc["counts"], entering) - same
            out = F.when(leaving >= 0, _term(gone) - _term(gone - 1)).otherwise(F.lit(0.0))
            total = acc["total"] - out + _term(had + 1) - _term(had)
            counts = F.transform(acc["counts"], lambda n, k: n + (k == entering).cast("int") - (k == leaving).cast("int"))
            return F.struct(total.alias("total"), counts.alias("counts"), acc["first"].alias("first"), acc["last"].alias("last"), i.alias("i"))

        def judged(acc: Column, i: Column) -> Column:
            return _let(run(acc, i), marked)

        return judged

    def marked(acc: Column) -> Column:
        i = acc["i"]
        reached = (i >= WINDOW - 1) & (F.round(F.lit(math.log2(WINDOW)) - acc["total"] / WINDOW, 6) >= bits)
        return F.struct(acc["total"].alias("total"), acc["counts"].alias("counts"), F.when(reached & (acc["first"] < 0), i).otherwise(acc["first"]).alias("first"), F.when(reached, i).otherwise(acc["last"]).alias("last"))

    zero = F.struct(F.lit(0.0).alias("total"), F.array_repeat(F.lit(0), LAST_CODE - FIRST_CODE + 1).alias("counts"), F.lit(-1).alias("first"), F.lit(-1).alias("last"))
    codes = F.transform(F.split(value, ""), lambda c: F.ascii(c) - FIRST_CODE)
    ends = lambda acc: F.struct(acc["first"].alias("first"), acc["last"].alias("last"))
    return _let(codes, lambda codes: F.aggregate(F.sequence(F.lit(0), F.size(codes) - 1), zero, step(codes), ends))


def _masked(value: Column) -> Column:
    for pattern, size in HARMLESS:
        value = F.regexp_replace(value, pattern, " " * size)
    return value


def _hot_spans(text: Column, pattern: str, classes: dict[str, tuple[str, float]]) -> Column:
    """Spans of the hot ranges in matches of ``pattern``, each judged by the first class it is of."""
    bits = lambda value: F.coalesce(*[F.when(value.rlike(test), F.lit(least)) for test, least in classes.values()])
    judged = F.transform(_pieces(text, pattern, 0), lambda m: F.struct(m["start"].alias("at"), m["value"].alias("value"), bits(m["value"]).alias("bits")))
    some = F.filter(judged, lambda m: m["bits"].isNotNull())
    ranged = F.transform(some, lambda m: F.struct(m["at"].alias("at"), m["value"].alias("value"), _hot_range(m["value"], m["bits"]).alias("r")))
    hot = lambda x: F.substring(_masked(x["value"]), x["r"]["first"] - (WINDOW - 2), x["r"]["last"] - x["r"]["first"] + WINDOW)
    own = lambda x: F.length(F.replace(hot(x), F.lit(" "), F.lit(""))) >= WINDOW
    return F.transform(
        F.filter(ranged, lambda x: (x["r"]["first"] >= 0) & own(x)),
        lambda x: F.struct((x["at"] + x["r"]["first"] - (WINDOW - 1)).cast("bigint").alias("start"), F.lit(3).alias("kind"), (x["at"] + x["r"]["last"] + 1).cast("bigint").alias("end")),
    ).cast(SPAN)


def _entropy(text: Column, base: Column) -> Column:
    """Hot spans of whole candidates and of the runs in them, without those inside another span.

    By start, then from the longest, base spans first, whatever a span lies in comes before it; so
    it lies in one if some earlier span ends no earlier.
    """
    spans = F.concat(base, _hot_spans(text, CANDIDATE, CLASSES), _hot_spans(text, RUN, CLASSES | RUN_CLASSES))
    ordered = F.array_sort(F.transform(spans, lambda s: F.struct(s["start"].alias("start"), (-s["end"]).alias("back"), s["kind"].alias("kind"))))
    kind = "struct<start:bigint,back:bigint,kind:int,upto:bigint>"
    passed = _scanned(ordered, F.lit(0).cast("bigint"), lambda upto, s: F.greatest(upto, -s["back"]), lambda upto, s: F.struct(s["start"].alias("start"), s["back"].alias("back"), s["kind"].alias("kind"), upto.alias("upto")), kind)
    own = F.filter(passed, lambda s: (s["kind"] == KINDS.index("entropy")) & (s["upto"] < -s["back"]))
    return F.transform(own, lambda s: F.struct(s["start"].alias("start"), s["kind"].alias("kind"), (-s["back"]).alias("end"))).cast(SPAN)


def scan_secrets(docs: DataFrame, text: str = "text") -> DataFrame:
    """Add ``base_spans`` and ``secret_spans``: sorted arrays of (start, kind, end).

    ``kind`` indexes ``KINDS``; the second array holds the first one's spans and those of entropy.
    """
    whole = F.coalesce(F.col(text), F.lit(""))
    found = docs.withColumn("base_spans", F.array_sort(F.concat(_base(whole, 0, ASSIGN, 2, 6), _base(whole, 1, ACCESS, 0, 20), _base(whole, 2, HEX, 0, 24))))
    return found.withColumn("secret_spans", F.array_sort(F.concat("base_spans", _entropy(whole, F.col("base_spans")))))


def spans_text(spans: Column) -> Column:
    """``kind:start:end`` of each span, comma-joined in order."""
    names = F.array(*map(F.lit, KINDS))
    return F.array_join(F.transform(spans, lambda s: F.concat_ws(":", F.get(names, s["kind"]), s["start"].cast("string"), s["end"].cast("string"))), ",")


def redact(text: Column, spans: Column, mark: str = "[SECRET]") -> Column:
    """``text`` with each stretch of overlapping sorted spans replaced by one ``mark``; null stays null.

    The stretches between are cut from the text block by block, so that no cut counts characters
    from the text's start.
    """
    kind = "struct<lo:bigint,hi:bigint,new:boolean>"
    gap = lambda upto, s: F.struct(upto.alias("lo"), s["start"].alias("hi"), (s["start"] >= upto).alias("new"))
    end = F.aggregate(spans, F.lit(0).cast("bigint"), lambda acc, s: F.greatest(acc, s["end"]))
    gaps = F.filter(_scanned(spans, F.lit(0).cast("bigint"), lambda upto, s: F.greatest(upto, s["end"]), gap, kind), lambda g: g["new"])
    part = lambda whole, at, lo, hi: F.substring(whole, (lo - at + 1).cast("int"), (hi - lo).cast("int"))

    def pieces(gaps: Column) -> Column:
        width = F.ceil(F.sqrt(F.size(gaps))).cast("int")
        blocks = F.transform(F.sequence(F.lit(0), F.ceil(F.size(gaps) / width).cast("int") - 1), lambda k: F.slice(gaps, k * width + 1, width))
        first, last = lambda b: F.get(b, F.lit(0))["lo"], lambda b: F.element_at(b, -1)["hi"]
        cut = lambda acc, b: F.struct(
            F.substring(acc["rest"], (last(b) - acc["at"] + 1).cast("int"), F.length(acc["rest"])).alias("rest"), last(b).alias("at"),
            F.concat(acc["out"], F.array(_let(F.struct(part(acc["rest"], acc["at"], first(b), last(b)).alias("text"), first(b).alias("at")), lambda x: F.transform(b, lambda g: part(x["text"], x["at"], g["lo"], g["hi"]))))).alias("out"))
        zero = F.struct(text.alias("rest"), F.lit(0).cast("bigint").alias("at"), F.array().cast("array<array<string>>").alias("out"))
        tail = lambda acc: F.concat(F.flatten(acc["out"]), F.array(F.substring(acc["rest"], (end - acc["at"] + 1).cast("int"), F.length(acc["rest"]))))
        return F.array_join(F.aggregate(blocks, zero, cut, tail), mark)

    return F.when(F.size(spans) > 0, _let(gaps, pieces)).otherwise(text)


def op9_secret_scan(spark, sf_dir):
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text")
    found = scan_secrets(docs).select("doc_id", "base_spans", "secret_spans")
    count = lambda kind: F.size(F.filter("base_spans", lambda s: s["kind"] == kind)).cast("bigint")
    return found.select(
        "doc_id", count(0).alias("n_assign"), count(1).alias("n_access"), count(2).alias("n_hex"),
        F.sha2(spans_text(F.col("base_spans")), 256).alias("base_sha256"), spans_text(F.col("secret_spans")).alias("spans"),
    )


def _duck_pieces(pattern: str, group: int) -> str:
    quoted = pattern.replace("'", "''")
    return f"""list_transform(range(1, len(regexp_extract_all(t, '{quoted}')) + 1), lambda i: {{
        'start': CAST(list_sum(list_transform(string_split_regex(t, '{quoted}')[1:i], lambda x: length(x))) + coalesce(list_sum(list_transform(regexp_extract_all(t, '{quoted}')[1:i - 1], lambda x: length(x))), 0) AS BIGINT),
        'size': length(regexp_extract_all(t, '{quoted}', {group})[i]), 'value': regexp_extract_all(t, '{quoted}')[i]}})"""


def _duck_base(kind: int, pattern: str, group: int, least: int) -> str:
    return f"list_transform(list_filter({_duck_pieces(pattern, group)}, lambda m: m.size >= {least}), lambda m: {{'start': m.start, 'kind': {kind}, 'end': m.start + length(m.value)}})"


def _duck_text(spans: str) -> str:
    return f"array_to_string(list_transform({spans}, lambda s: ['assign', 'access', 'hex', 'entropy'][s.kind + 1] || ':' || s.start || ':' || s.end), ',')"


def _duck_bits(classes: dict[str, tuple[str, float]]) -> str:
    """CASE of the first class a value is of; what a look-ahead asks for is asked for by itself."""
    whens = []
    for test, least in classes.values():
        needs = re.findall(r"\(\?=\.\*(\[[^\]]*\])\)", test)
        plain = re.sub(r"\(\?=[^)]*\)", "", test)
        whens.append("WHEN " + " AND ".join(f"regexp_matches(m.value, '{x}')" for x in [*needs, plain]) + f" THEN {least}")
    return f"CASE {' '.join(whens)} END"


def oracle() -> str:
    """All classes of whole candidates and of the runs in them, and the allow-list laid over hot spans."""
    window = f"v[i + 1:i + {WINDOW}]"
    entropy = f"round(-list_sum(list_transform(list_distinct(string_split({window}, '')), lambda c: (length({window}) - length(replace({window}, c, ''))) / {WINDOW}.0 * log2((length({window}) - length(replace({window}, c, ''))) / {WINDOW}.0))), 6)"
    masked = "v"
    for pattern, size in HARMLESS:
        masked = f"regexp_replace({masked}, '{pattern}', '{' ' * size}', 'g')"
    pieces = lambda kind, pattern, classes: f"SELECT rid, b, {kind} AS kind, m.start AS p0, m.value AS v, {_duck_bits(classes)} AS bits FROM (SELECT rid, b, unnest({_duck_pieces(pattern, 0)}) AS m FROM base)"
    return f"""
    WITH d AS (SELECT row_number() OVER () AS rid, doc_id, coalesce(text, '') AS t FROM documents),
    base AS (SELECT rid, doc_id, t, list_sort(list_concat({_duck_base(0, ASSIGN, 2, 6)}, list_concat({_duck_base(1, ACCESS, 0, 20)}, {_duck_base(2, HEX, 0, 24)}))) AS b FROM d),
    cand AS ({pieces(1, CANDIDATE, CLASSES)} UNION ALL {pieces(2, RUN, CLASSES | RUN_CLASSES)}),
    wins AS (SELECT rid, b, kind, p0, v, bits, i, {entropy} AS h FROM (SELECT *, unnest(range(0, length(v) - {WINDOW} + 1)) AS i FROM cand WHERE bits IS NOT NULL)),
    ranges AS (SELECT rid, any_value(b) AS b, any_value(v) AS v, p0, min(i) AS lo, max(i) + {WINDOW} AS hi FROM wins WHERE h >= bits GROUP BY rid, kind, p0),
    hot AS (SELECT DISTINCT rid, b, {{'start': p0 + lo, 'kind': 3, 'end': p0 + hi}} AS s FROM ranges WHERE length(replace(substring({masked}, lo + 1, hi - lo), ' ', '')) >= {WINDOW}),
    extra AS (SELECT rid, list(s) AS e FROM hot h WHERE len(list_filter(b, lambda x: x.start <= s.start AND x.end >= s.end)) = 0
      AND NOT EXISTS (SELECT 1 FROM hot o WHERE o.rid = h.rid AND o.s <> h.s AND o.s.start <= h.s.start AND o.s.end >= h.s.end) GROUP BY rid)
    SELECT doc_id, len(list_filter(b, lambda s: s.kind = 0)) AS n_assign, len(list_filter(b, lambda s: s.kind = 1)) AS n_access, len(list_filter(b, lambda s: s.kind = 2)) AS n_hex,
      sha256({_duck_text('b')}) AS base_sha256, {_duck_text('list_sort(list_concat(b, coalesce(e, [])))')} AS spans
    FROM base LEFT JOIN extra USING (rid)"""
