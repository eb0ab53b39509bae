"""Operator 7: secret scans with multipart credential linking. DataFrame functions only: no Python runs on rows.

Strong parts (assign, access, hex) are always reported. Weak parts (ident: a user or client name that is assigned;
blob: a long mixed string that is no part of an address; endpoint: a host or URL that is assigned, or a URL with a user
part) are reported only when parts that complete them are near, in the same block: an ident needs a secret, an endpoint
a secret and an identifier, and a blob must be the secret that is nearest to an identifier (of two as near the first).
Near is a gap of at most REACH code points. Blocks end at blank lines, at lines that are a [section], and between one
closed object and the next, so records of a list and sections of a file do not complete each other. So what a weak part
can link to is bounded however long a text without blank lines is, and links or digests in prose around it stay.

The interval join of parts, blocks and reaches is one sort by place inside the row: the nearest part of a kind and the
nearest break on either side are running maxima and minima. Nothing is shuffled and no key can grow hot.

Places of all matches come from the matches and the pieces between them, whose lengths add up. Running sums and maxima
go through lists in blocks of BLOCK entries, so their cost grows with the number of parts and not with its square.

Defined results: null texts are empty; positions count code points; repeated rows repeat; a text without parts has
zero counts, the digest of an empty string and empty spans; a weak part that overlaps a strong one is part of that;
columns of docs that clash with result columns are replaced, others stay; an empty table gives an empty result.
"""

from __future__ import annotations

from collections.abc import Callable
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

#: The patterns of the strong kinds, in the order in which kinds of one start are listed.
ASSIGN = r"""(?i:(password|passwd|secret|token|api_?key))["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)"""
ACCESS = r"AKIA[A-Z0-9]{16,}+"
HEX = r"[0-9a-f]{24,}+"
#: Weak kinds.
IDENT = r"""(?<![A-Za-z0-9_])(?i:(user|user_?name|login|account|client_?id|access_?key_?id))["']?\x20*[:=]\x20*["']?[A-Za-z0-9_.@+-]{3,}+"""
BLOB = r"(?<![A-Za-z0-9+/_.-])(?!//)[A-Za-z0-9+/_-]{20,}+(?:\.[A-Za-z0-9_-]{20,}+)*+={0,2}"
ENDPOINT = r"""(?<![A-Za-z0-9+._-])(?i:[a-z][a-z0-9+.-]{1,20}+://[^\s/@"'<>{}]{1,256}+@[a-z0-9.-]+(?::[0-9]+)?|(?:host|server|endpoint|base_?url|api_?url)["']?\x20*[:=]\x20*["']?(?:[a-z][a-z0-9+.-]{1,20}+://)?[a-z0-9.-]{4,}+(?::[0-9]+)?)"""
KINDS = ("assign", "access", "hex", "ident", "blob", "endpoint")
#: What ends a block. No part contains a line end or a brace.
SCOPE = r"""\n[ \t\r]*+\n|\n[ \t]*+\[[^\]\n]{1,100}+\](?=[ \t\r]*+\n)|\}[ \t\r\n]*+(?:,[ \t\r\n]*+)?+(?:(?:"[^"\n]{0,64}+"|[A-Za-z_][A-Za-z0-9_]{0,63}+)[ \t]*+[:=][ \t]*+)?+\{"""
#: Code points between a part and one that completes it, at most.
REACH = 1_000
BREAK = len(KINDS)
BLOCK = 64
FAR = 2**31 - 1
REDACTED = "[SECRET]"
SPAN = "array<struct<start:int,kind:int,end:int,value:string>>"


def bound(value: Column, use: Callable[[Column], Column]) -> Column:
    """use(value) with value computed once, however often use mentions it, inside of lambdas too."""
    return F.get(F.transform(F.array(value), use), F.lit(0))


def running(items: Column, value: Callable[[Column], Column], combine: Callable[[Column, Column], Column], zero: int) -> Column:
    """For each item the combined values of all items before it."""
    start = F.lit(zero).cast("int")

    def of(items: Column) -> Column:
        n = F.floor((F.size(items) + (BLOCK - 1)) / BLOCK).cast("int")
        places = F.when(F.size(items) > 0, F.sequence(F.lit(0), n - 1)).otherwise(F.array().cast("array<int>"))
        blocks = F.transform(places, lambda k: F.slice(items, k * BLOCK + 1, BLOCK))

        def pairs(list_: Column, first: Column, of_one: Callable[[Column], Column]) -> Column:
            begin = F.struct(first.alias("now"), F.array().cast("array<int>").alias("out"))
            return F.aggregate(list_, begin, lambda acc, x: F.struct(combine(acc["now"], of_one(x)).cast("int").alias("now"), F.concat(acc["out"], F.array(acc["now"])).alias("out")))["out"]

        def inside(blocks: Column) -> Column:
            sums = F.transform(blocks, lambda b: F.aggregate(b, start, lambda acc, x: combine(acc, value(x)).cast("int")))
            before = pairs(sums, start, lambda x: x)
            return F.flatten(F.transform(F.arrays_zip(blocks.alias("b"), before.alias("s")), lambda z: pairs(z["b"], z["s"], value)))

        return bound(blocks, inside)

    return bound(items, of)


def located(text: Column, pattern: str, matches: Column, kind: int) -> Column:
    """Spans of all matches. The matches and the pieces between them alternate, so starts are sums of lengths."""

    def spans(pieces: Column) -> Column:
        size = lambda p: F.length(p["gap"]) + F.coalesce(F.length(p["value"]), F.lit(0))
        at = running(pieces, size, lambda a, b: a + b, 0)
        both = F.filter(F.arrays_zip(pieces.alias("p"), at.alias("at")), lambda z: z["p"]["value"].isNotNull())

        def span(z: Column) -> Column:
            start = z["at"] + F.length(z["p"]["gap"])
            return F.struct(start.alias("start"), F.lit(kind).alias("kind"), (start + F.length(z["p"]["value"])).alias("end"), z["p"]["value"].alias("value"))

        return F.transform(both, span)

    pieces = F.arrays_zip(F.split(text, pattern, -1).alias("gap"), matches.alias("value"))
    return F.when(F.size(matches) > 0, bound(pieces, spans)).otherwise(F.array().cast(SPAN))


def is_base(s: Column) -> Column:
    return s["kind"] < 3


def apart(items: Column, over: Callable[[Column], Column], under: Callable[[Column], Column]) -> Column:
    """items, in order of place, without those of under that overlap one of over."""
    latest = running(items, lambda s: F.when(over(s), s["end"]).otherwise(0), F.greatest, 0)
    back = F.reverse(running(F.reverse(items), lambda s: F.when(over(s), s["start"]).otherwise(FAR), F.least, FAR))
    marked = F.arrays_zip(items.alias("s"), latest.alias("latest"), back.alias("next"))
    free = lambda z: ~under(z["s"]) | ((z["latest"] <= z["s"]["start"]) & (z["next"] >= z["s"]["end"]))
    return F.transform(F.filter(marked, free), lambda z: z["s"])


def kind_in(*kinds: str) -> Callable[[Column], Column]:
    return lambda s: s["kind"].isin(*map(KINDS.index, kinds))


def gaps(z: Column, part: str) -> tuple[Column, Column]:
    """From the latest and to the soonest of these parts in the block of z."""
    before = F.when(z[f"{part}0"] > z["break0"], F.greatest(z["s"]["start"] - z[f"{part}0"], F.lit(0))).otherwise(FAR)
    after = F.when(z[f"{part}1"] < z["break1"], F.greatest(z[f"{part}1"] - z["s"]["end"], F.lit(0))).otherwise(FAR)
    return before, after


def measured(z: Column) -> Column:
    """Whether a secret and an identifier are near, and on which side an identifier has its nearest secret."""
    before, after = gaps(z, "secret")
    near = F.least(before, after) <= REACH
    chooses = kind_in("access", "ident")(z["s"]) & near
    return F.struct(
        z["s"].alias("s"), z["secret0"].alias("secret0"), z["secret1"].alias("secret1"), near.alias("secret"),
        (F.least(*gaps(z, "identifier")) <= REACH).alias("identifier"), (chooses & (before <= after)).alias("back"), (chooses & (before > after)).alias("on"),
    )


def complete(z: Column) -> Column:
    m = z["m"]
    ident, blob, endpoint = (kind_in(k)(m["s"]) for k in ("ident", "blob", "endpoint"))
    chosen = (z["from0"] > m["secret0"]) | (z["from1"] < m["secret1"])  # no other secret lies between
    return is_base(m["s"]) | (ident & m["secret"]) | (endpoint & m["secret"] & m["identifier"]) | (blob & chosen)


def linked(found: DataFrame) -> DataFrame:
    """found with __items, in order of place, cut down to base spans and the weak ones that parts near them complete.

    Steps are columns of their own: lambdas nested in each other take the analyser time that doubles with each level.
    """
    items = F.col("__items")
    latest = lambda items, of, end: running(items, lambda s: F.when(of(s), end(s)).otherwise(-1), F.greatest, -1)
    soonest = lambda items, of: F.reverse(running(F.reverse(items), lambda s: F.when(of(s), s["start"]).otherwise(FAR), F.least, FAR))
    sides = {}
    for name, of in (("break", lambda s: s["kind"] == BREAK), ("secret", kind_in("assign", "hex", "blob")), ("identifier", kind_in("access", "ident"))):
        end = "start" if name == "break" else "end"
        sides |= {f"{name}0": latest(items, of, lambda s, end=end: s[end]), f"{name}1": soonest(items, of)}
    found = found.withColumns({f"__{name}": side for name, side in sides.items()})
    found = found.withColumn("__marked", F.transform(F.arrays_zip(items.alias("s"), *(F.col(f"__{name}").alias(name) for name in sides)), measured))
    marked = F.col("__marked")
    places = F.transform(marked, lambda m: F.struct(m["s"]["start"].alias("start"), m["s"]["end"].alias("end"), m["on"].alias("on"), m["back"].alias("back")))
    found = found.withColumn("__places", places)
    found = found.withColumns({"__from0": latest(F.col("__places"), lambda m: m["on"], lambda m: m["end"]), "__from1": soonest(F.col("__places"), lambda m: m["back"])})
    chosen = F.arrays_zip(marked.alias("m"), F.col("__from0").alias("from0"), F.col("__from1").alias("from1"))
    return found.withColumn("__items", F.transform(F.filter(chosen, complete), lambda z: z["m"]["s"]))


def shown(spans: Column) -> Column:
    names = F.array(*map(F.lit, KINDS))
    return F.array_join(F.transform(spans, lambda s: F.concat_ws(":", names[s["kind"]], s["start"].cast("string"), s["end"].cast("string"))), ",")


def parts_of(docs: DataFrame, text_col: str) -> DataFrame:
    """docs with __base, __all (spans in order)."""
    text = F.col("__text")
    found = docs.withColumn("__text", F.coalesce(F.col(f"`{text_col}`").cast("string"), F.lit("")))
    none = F.array().cast("array<string>")
    found = found.withColumns({
        "__m0": F.regexp_extract_all(text, F.lit(ASSIGN), F.lit(0)),
        "__m1": F.when(text.contains("AKIA"), F.regexp_extract_all(text, F.lit(ACCESS), F.lit(0))).otherwise(none),
        "__m2": F.regexp_extract_all(text, F.lit(HEX), F.lit(0)),
        "__m3": F.regexp_extract_all(text, F.lit(IDENT), F.lit(0)),
        "__m4": F.regexp_extract_all(text, F.lit(BLOB), F.lit(0)),
    })
    parts = reduce(lambda a, b: a + b, (F.size(f"__m{i}") for i in range(5)))
    found = found.withColumn("__m5", F.when(parts > 0, F.regexp_extract_all(text, F.lit(ENDPOINT), F.lit(0))).otherwise(none))
    found = found.withColumn("__m6", F.when(parts > 0, F.regexp_extract_all(text, F.lit(SCOPE), F.lit(0))).otherwise(none))
    for i, pattern in enumerate((ASSIGN, ACCESS, HEX, IDENT, BLOB, ENDPOINT, SCOPE)):
        found = found.withColumn(f"__s{i}", located(text, pattern, F.col(f"__m{i}"), i))
    long_enough = F.filter("__s0", lambda s: F.length(F.regexp_extract(s["value"], ASSIGN, 2)) >= 6)
    found = found.withColumn("__base", F.array_sort(F.concat(long_enough, "__s1", "__s2")))
    mixed = F.filter("__s4", lambda s: s["value"].rlike("[0-9]") & s["value"].rlike("[A-Z]") & s["value"].rlike("[a-z]"))
    found = found.withColumn("__weak", F.concat("__s3", mixed, "__s5"))
    # a weak part that overlaps a base span is part of that; the value of an ident or endpoint is no blob of its own
    weak, names = kind_in("ident", "blob", "endpoint"), kind_in("ident", "endpoint")
    some = F.size("__weak") > 0
    found = found.withColumn("__items", F.when(some, F.array_sort(F.concat("__base", "__weak", "__s6"))).otherwise(F.array().cast(SPAN)))
    found = found.withColumn("__items", apart(F.col("__items"), is_base, weak))
    found = linked(found.withColumn("__items", apart(F.col("__items"), names, kind_in("blob"))))
    return found.withColumn("__all", F.when(some, F.col("__items")).otherwise(F.col("__base")))


def scan(docs: DataFrame, text_col: str = "text") -> DataFrame:
    """docs with n_assign, n_access, n_hex, base_sha256, spans, n_weak."""
    found = parts_of(docs, text_col)
    count = lambda kind: F.size(F.filter("__base", lambda s: s["kind"] == kind)).cast("long")
    columns = {
        "n_assign": count(0), "n_access": count(1), "n_hex": count(2),
        "base_sha256": F.sha2(shown(F.col("__base")), 256),
        "spans": shown(F.col("__all")),
        "n_weak": (F.size("__all") - F.size("__base")).cast("long"),
    }
    kept = [F.col(f"`{c}`") for c in docs.columns if c not in columns]
    return found.select(*kept, *(c.alias(n) for n, c in columns.items()))


def redact(docs: DataFrame, text_col: str = "text") -> DataFrame:
    """docs with every reported span (overlapping ones together) replaced by a placeholder; null texts stay null."""
    found = parts_of(docs, text_col)
    text = F.col("__text")
    start = F.struct(F.lit(0).alias("at"), F.lit("").alias("out"))

    def step(acc: Column, s: Column) -> Column:
        gap = F.concat(acc["out"], F.substring(text, acc["at"] + 1, s["start"] - acc["at"]), F.lit(REDACTED))
        return F.struct(F.greatest(acc["at"], s["end"]).alias("at"), F.when(s["start"] < acc["at"], acc["out"]).otherwise(gap).alias("out"))

    done = F.aggregate("__all", start, step, lambda acc: F.concat(acc["out"], F.substring(text, acc["at"] + 1, F.length(text))))
    new = F.when(F.size("__all") > 0, done).otherwise(F.col(f"`{text_col}`"))
    return found.select(*(new.alias(c) if c == text_col else F.col(f"`{c}`") for c in docs.columns))
