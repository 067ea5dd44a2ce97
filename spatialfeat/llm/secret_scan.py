"""Secret scans with multipart credential linking, by DataFrame functions only.

Named assignments, access identifiers and long hexadecimal runs are reported wherever they stand. Parts that say little alone (a
user name, a value called `auth`, a long mixed token, the address of a service) are weak: an identifier is reported only if a secret
stands within `reach` code points of it, a secret only if an identifier does, an endpoint only if it is that close to an identifier
which has a secret. Strong findings count as parts: access identifiers as identifiers, assignments and hexadecimal runs as secrets.

* Places: a text is split by a pattern; the lengths of the pieces and of the matches, summed up in order, are where matches start. The
  sums are a window over the matches of one text and kind, so a text with very many of them is sorted, not held in one value.
* Interval join: the scope of a part is what it covers and `reach` around it. Texts are cut into cells of a fixed length; parts go to the
  cells that they, or their scopes, touch, and meet in a semi-join by text and cell. A cell holds a bounded number of parts, no pairs are
  made, and parts of one text are dealt over many keys. Only texts with a weak part, an identifier and a secret get there.
* The texts are read once; what follows has lengths and places only.

Defined cases: a null text is empty; a row without findings has none; places are code points, ends exclusive; matches of one kind do
not overlap, those of different kinds may, but a weak one that overlaps a strong one is dropped, as are links between parts that overlap; equal
rows, also without ids, are rows of their own; the columns named in `keep` come along, an output of the same name wins; no rows give no rows.
"""

from __future__ import annotations

from functools import reduce
from operator import or_

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from .common import carried, materialise

#: Code points between two parts that belong together.
REACH = 256


def either(words: str) -> str:
    """A pattern for words in either case of A-Z; the same in every engine, whatever it folds."""
    return "".join(f"[{c.upper()}{c}]" if c.isalpha() else c for c in words)


_IS = r"""["']?\x20*[:=]\x20*["']?"""
#: Kinds in order, strong ones first: pattern, its group that is measured, and how long that has to be.
KINDS = {
    "assign": (rf"({either('password|passwd|secret|token|api_?key')}){_IS}([A-Za-z0-9+/_.=-]+)", 2, 6),
    "access": (r"AKIA[A-Z0-9]+", 0, 20),
    "hex": (r"[0-9a-f]{24,}", 0, 24),
    "ident": (rf"({either('user_?name|user_?id|user|login|client_?id|account_?id|access_?key_?id')}){_IS}([A-Za-z0-9+/_.@-]+)", 2, 3),
    "key": (rf"({either('passphrase|passcode|pass|pwd|auth|bearer|credentials?|private_?key|access_?key|signature')}){_IS}([A-Za-z0-9+/_.=-]+)", 2, 6),
    "blob": (r"[A-Za-z0-9+/]{32,}", 0, 32),
    "endpoint": (rf"((?:https?|wss?|s?ftp|ssh|s3|jdbc:[a-z]+|postgres(?:ql)?|mysql|mongodb|redis|amqps?)://|(?:{either('hostname|host|endpoint|server|base_?url')}){_IS})([A-Za-z0-9._~:/@%?&=+-]+)", 2, 4),
}
NAMES = tuple(KINDS)
#: What stands in every match, in lower case: texts without any of these are not searched by pattern.
CLUES = {"assign": ("passw", "secret", "token", "api"), "access": ("akia",), "ident": ("user", "login", "client", "account", "access")}
STRONG = ("assign", "access", "hex")
IDENTIFIERS = ("access", "ident")
SECRETS = ("assign", "hex", "key", "blob")
#: What a blob must have, each at least once.
MIXED = ("[0-9]", "[A-Z]", "[a-z]")


def _matches(text: Column, kind: str) -> Column:
    """kind, k, gap (code points before it since the last match), size, and whether it is long enough, of every match in order."""
    pattern, group, least = KINDS[kind]
    p = F.lit(pattern)
    pieces, whole = F.split(text, pattern, -1), F.regexp_extract_all(text, p, F.lit(0))
    measured = whole if group == 0 else F.regexp_extract_all(text, p, F.lit(group))
    number = F.lit(NAMES.index(kind))

    def one(match: Column, k: Column) -> Column:
        ok = F.length(F.get(measured, k)) >= least
        if kind == "blob":
            for m in MIXED:
                ok = ok & match.rlike(m)
        return F.struct(number.alias("kind"), k.alias("k"), F.length(F.get(pieces, k)).alias("gap"), F.length(match).alias("size"), ok.alias("ok"))

    none = F.array().cast("array<struct<kind: int, k: int, gap: int, size: int, ok: boolean>>")
    low = F.lower(text)
    clues = CLUES.get(kind, ()) if kind in STRONG else CLUES["ident"]
    there = reduce(or_, (low.contains(c) for c in clues), F.lit(not clues))
    if kind not in (*STRONG, "ident"):  # of no use without an identifier
        there = there | text.contains("AKIA")
    return F.when(there & text.rlike(pattern), F.transform(whole, one)).otherwise(none)


def _is(kinds: tuple[str, ...]) -> Column:
    return F.col("kind").isin(*(NAMES.index(k) for k in kinds))


def _spans(cut: DataFrame) -> DataFrame:
    """row, kind, start, end, ok of all matches."""
    each = cut.select("row", F.explode("matches").alias("m")).select("row", "m.*")
    so_far = Window.partitionBy("row", "kind").orderBy("k").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    end = F.sum(F.col("gap").cast("long") + F.col("size")).over(so_far)
    return each.select("row", "kind", (end - F.col("size")).alias("start"), end.alias("end"), "ok")


def _meeting(left: DataFrame, right: DataFrame, reach: int, overlap: bool) -> DataFrame:
    """Rows of left with a row of right that overlaps, or that does not but stands within reach: a semi-join by text and cell."""
    width = 2 * max(reach, REACH)
    cells = lambda by: F.explode(F.sequence(F.floor((F.col("start") - by) / width), F.floor((F.col("end") + by) / width)))
    a = left.withColumn("cell", cells(reach)).alias("a")
    b = right.select("row", "start", "end", cells(0).alias("cell")).alias("b")
    crossing = (F.col("a.start") < F.col("b.end")) & (F.col("b.start") < F.col("a.end"))
    close = (F.col("a.start") <= F.col("b.end") + reach) & (F.col("b.start") <= F.col("a.end") + reach)
    here = (F.col("a.row") == F.col("b.row")) & (F.col("a.cell") == F.col("b.cell"))
    return a.join(b, here & (crossing if overlap else close & ~crossing), "left_semi").drop("cell").dropDuplicates(["row", "kind", "start"])


def _linked(spans: DataFrame, reach: int) -> DataFrame:
    """The weak spans that complementary parts report."""
    strong, weak = spans.where(_is(STRONG)), spans.where(~_is(STRONG))
    covered = _meeting(weak, strong, 0, True)
    parts = materialise(strong.unionByName(weak.join(covered, ["row", "kind", "start"], "left_anti").select(*strong.columns)))
    identifiers, secrets = parts.where(_is(IDENTIFIERS)), parts.where(_is(SECRETS))
    whole = materialise(_meeting(identifiers, secrets, reach, False))
    own = secrets.where(~_is(STRONG))
    points = parts.where(_is(("endpoint",)))
    return whole.where(~_is(STRONG)).unionByName(_meeting(own, whole, reach, False)).unionByName(_meeting(points, whole, reach, False))


def scan(docs: DataFrame, keep: list[str], text: str = "text", reach: int = REACH) -> DataFrame:
    """The columns named in keep, and secrets: kind, start and end of what is found, by start and kind."""
    keep = carried(keep, ("secrets",))
    body = F.coalesce(F.col(text), F.lit(""))
    cut = docs.select(F.monotonically_increasing_id().alias("row"), F.struct(F.lit(True).alias("_"), *(F.col(f"`{c}`") for c in keep)).alias("kept"), F.concat(*(_matches(body, k) for k in NAMES)).alias("matches"))
    cut = materialise(cut)
    has = lambda kinds: F.exists("matches", lambda m: m["kind"].isin(*(NAMES.index(k) for k in kinds)) & m["ok"])
    weak = tuple(k for k in NAMES if k not in STRONG)
    spans = materialise(_spans(cut.where(F.size("matches") > 0)).where("ok").drop("ok"))
    linkable = cut.where(has(weak) & has(IDENTIFIERS) & has(SECRETS)).select("row")
    found = spans.where(_is(STRONG)).unionByName(_linked(spans.join(linkable, "row", "left_semi"), reach))
    names = F.array(*(F.lit(n) for n in NAMES))
    ordered = F.transform(F.array_sort(F.collect_list(F.struct("start", "kind", "end"))), lambda s: F.struct(F.get(names, s["kind"]).alias("kind"), s["start"].alias("start"), s["end"].alias("end")))
    secrets = found.groupBy("row").agg(ordered.alias("secrets"))
    none = F.array().cast(secrets.schema["secrets"].dataType)
    return cut.select("row", "kept").join(secrets, "row", "left").select(*(F.col(f"kept.`{c}`").alias(c) for c in keep), F.coalesce("secrets", none).alias("secrets"))


def written(secrets: Column) -> Column:
    """kind:start:end, comma-joined."""
    return F.array_join(F.transform(secrets, lambda s: F.concat_ws(":", s["kind"], s["start"].cast("string"), s["end"].cast("string"))), ",")
