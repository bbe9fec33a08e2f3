"""Secret scan with corpus-wide ownership frequency, in built-in expressions only.

Every text is searched for candidates. Candidate values are hashed and counted over the corpus
by distinct owners and distinct repositories: a value that many owners carry is an example
copied from somewhere, one that stays with its owners is a live-looking credential.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .scratch import Scratch

# The patterns of the base kinds (names in letters of either case).
ASSIGN = (r"""([pP][aA][sS][sS][wW][oO][rR][dD]|[pP][aA][sS][sS][wW][dD]|[sS][eE][cC][rR][eE][tT]|[tT][oO][kK][eE][nN]"""
          r"""|[aA][pP][iI]_?[kK][eE][yY])["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""")
#: These runs end where no more characters fit, so a least length in the pattern drops just the short ones.
ACCESS = r"AKIA[A-Z0-9]{16,}"
HEX = r"[0-9a-f]{24,}"
#: The method's own kind: long strings that mix cases and digits.
OPAQUE = r"[A-Za-z0-9+/_-]{24,}"
ASSIGN_CHARS = 6
#: In the order in which spans of one start are listed.
KINDS = ("assign", "access", "hex", "opaque")
BASE = KINDS[:3]
#: A value with more owners than this is a copied example.
MAX_OWNERS = 3

#: Spans handled one after the other; longer lists are cut into runs of this length, so that the cost does not grow with their square.
RUN = 256

SPANS = "array<struct<start:int,rank:int,end:int,kind:string,hash:string>>"

#: An identifier of 8-4-4-4-12 hexadecimal digits, and what joins the parts of paths and slugs.
UUID = r"^[0-9A-Fa-f]{8}-[0-9A-Fa-f]{4}-[0-9A-Fa-f]{4}-[0-9A-Fa-f]{4}-[0-9A-Fa-f]{12}$"
JOINTS = r"[/+_-]"
#: Parts of names in running case.
NAME_PART = r"[A-Z]?[a-z]{3,}"
CASE_RUN = r"[A-Z]+|[a-z]+|[0-9]+"
LEAST_DIFFERENT = 12


def _let(value: Column, use: Callable[[Column], Column]) -> Column:
    """``use(value)`` with the value computed once, however often it is used."""
    return F.element_at(F.transform(F.array(value), use), 1)


def _looks_live(value: Column) -> Column:
    """Whether a string looks generated: both cases and digits, at least twelve different characters, and, without joints,
    at least two fifths outside of parts of names and three changes between cases and digits in ten characters. A random
    string of 24 letters and digits has 14 changes and a fifth in such parts; paths, slugs, identifiers of code and UUIDs fail."""
    core = F.regexp_replace(value, JOINTS, "")
    outside = F.length(F.regexp_replace(core, NAME_PART, ""))
    changes = F.size(F.regexp_extract_all(core, F.lit(CASE_RUN), F.lit(0))) - 1
    return (value.rlike("[0-9]") & value.rlike("[A-Z]") & value.rlike("[a-z]") & ~value.rlike(UUID)
            & (F.size(F.array_distinct(F.split(value, ""))) >= LEAST_DIFFERENT)
            & (5 * outside >= 2 * F.length(core)) & (10 * changes >= 3 * F.length(core)))


def _runs(values: Column) -> Column:
    """An array cut into runs of ``RUN`` elements; an empty one is one empty run."""
    return F.transform(F.sequence(F.lit(1), F.greatest(F.size(values), F.lit(1)), F.lit(RUN)), lambda at: F.slice(values, at, F.lit(RUN)))


def _running(values: Column, step: Callable[[Column, Column], Column]) -> Column:
    """0 and what ``step`` makes of it with each of the values in turn."""
    return F.aggregate(values, F.array(F.lit(0)), lambda s, x: F.concat(s, F.array(step(F.element_at(s, -1), x))))


def _spans(text: Column, kind: str, pattern: str, group: int = 0, least: int = 0) -> Column:
    """Leftmost non-overlapping matches of one kind, in code points. A match starts after the pieces
    between the matches and the matches before it; those with a short ``group`` are dropped."""
    whole = F.regexp_extract_all(text, F.lit(pattern), F.lit(0))
    value = whole if group == 0 else F.regexp_extract_all(text, F.lit(pattern), F.lit(group))
    gaps = F.slice(F.split(text, pattern, -1), F.lit(1), F.size(whole))
    sizes = F.zip_with(gaps, whole, lambda g, w: F.struct(F.length(g).alias("gap"), F.length(w).alias("n")))
    parts = F.zip_with(sizes, value, lambda p, v: F.struct(p["gap"].alias("gap"), p["n"].alias("n"), v.alias("v")))
    none = F.array().cast("array<struct<start:int,end:int,v:string>>")

    def place(run: Column, at: Column) -> Column:
        return F.aggregate(
            run, F.struct(at.alias("at"), none.alias("out")),
            lambda s, p: F.struct(
                (s["at"] + p["gap"] + p["n"]).alias("at"),
                F.when(F.length(p["v"]) >= least, F.concat(s["out"], F.array(F.struct(
                    (s["at"] + p["gap"]).alias("start"), (s["at"] + p["gap"] + p["n"]).alias("end"), p["v"].alias("v")))))
                .otherwise(s["out"]).alias("out")),
            lambda s: s["out"])

    def place_all(runs: Column) -> Column:
        lengths = F.transform(runs, lambda run: F.aggregate(run, F.lit(0), lambda n, p: n + p["gap"] + p["n"]))
        starts = F.slice(_running(lengths, lambda at, n: at + n), F.lit(1), F.size(runs))
        return F.flatten(F.zip_with(runs, starts, place))

    placed = _let(parts, lambda p: _let(_runs(p), place_all))
    if kind == "opaque":
        placed = F.filter(placed, lambda m: _looks_live(m["v"]))
    spans = F.transform(placed, lambda m: F.struct(
        m["start"].alias("start"), F.lit(KINDS.index(kind)).alias("rank"), m["end"].alias("end"), F.lit(kind).alias("kind"),
        F.sha2(m["v"], 256).alias("hash")))
    return F.when(text.rlike(pattern), spans).otherwise(F.array().cast(SPANS)).cast(SPANS)


def candidates(text: Column) -> Column:
    """All candidate spans of a text (null: none)."""
    text = F.coalesce(text, F.lit(""))
    return F.concat(_spans(text, "assign", ASSIGN, 2, ASSIGN_CHARS), _spans(text, "access", ACCESS),
                    _spans(text, "hex", HEX), _spans(text, "opaque", OPAQUE))


def ownership(found: DataFrame, owner: str, repository: list[str]) -> DataFrame:
    """(hash, n_owners, n_repositories) over all candidates. Null is an owner like others. Each
    step is reduced before its shuffle, so a value in a third of all rows stays a few rows."""
    carried = found.groupBy("hash", F.col(owner).alias("_o"), F.struct(*repository).alias("_r")).agg(F.count("*").alias("_1"))
    by_owner = carried.groupBy("hash", "_o").agg(F.count("*").alias("_n"))
    return by_owner.groupBy("hash").agg(F.count("*").alias("n_owners"), F.sum("_n").alias("n_repositories"))


def find_secrets(docs: DataFrame, text: str = "text", owner: str = "source", repository: tuple[str, ...] = ("source", "lang"),
                 max_owners: int = MAX_OWNERS, keep: list[str] | None = None, into: str = "secrets") -> DataFrame:
    """The rows of ``docs`` (columns ``keep``, default all) with ``into``: an array of
    (start, end, kind, verdict, n_owners, n_repositories), by start, then kind.

    Base spans are always listed, with the verdict ``example`` where more than ``max_owners``
    owners carry the value, else ``live``. Opaque strings are added where they look generated,
    at most ``max_owners`` owners have them and no base span overlaps them.

    Null and empty texts have no spans; repeated rows stay repeated; an empty table gives an
    empty result. Spans follow from the text and the counts alone, so rows with equal texts get
    equal spans. A column of ``docs`` that is named ``into`` is replaced.
    """
    scratch = Scratch(docs.sparkSession, "secrets")
    keep = [c for c in (keep or docs.columns) if c != into]
    repo = list(dict.fromkeys(repository))
    slim = docs.select(F.col(owner).alias("_owner"),
                       F.struct(*[F.col(c).alias(f"_{i}") for i, c in enumerate(repo)]).alias("_repo"),
                       *[F.col(c).alias(f"_keep_{i}") for i, c in enumerate(keep)], candidates(F.col(text)).alias("_found"))
    rows = scratch.keep(slim.withColumn("_row", F.monotonically_increasing_id()), "candidates")
    single = rows.where(F.size("_found") > 0).select("_row", "_owner", "_repo", F.explode("_found").alias("s"))
    owned = ownership(single.select(F.col("s.hash").alias("hash"), "_owner", "_repo"), "_owner", ["_repo"])
    judged = single.join(owned, F.col("s.hash") == owned["hash"]).select(
        "_row", F.struct(
            "s.start", "s.rank", "s.end", "s.kind",
            F.when(F.col("n_owners") > max_owners, F.lit("example")).otherwise(F.lit("live")).alias("verdict"),
            "n_owners", "n_repositories").alias("s"))
    # a base span overlaps one of another kind if it starts before it and reaches into it, or starts inside of it
    base = F.col("s.rank") < len(BASE)
    up = Window.partitionBy("_row").orderBy("s.start", "s.rank").rowsBetween(Window.unboundedPreceding, 0)
    down = Window.partitionBy("_row").orderBy(F.desc("s.start"), F.desc("s.rank")).rowsBetween(Window.unboundedPreceding, 0)
    around = judged.withColumns({"_reach": F.max(F.when(base, F.col("s.end"))).over(up), "_next": F.min(F.when(base, F.col("s.start"))).over(down)})
    clear = (F.coalesce("_reach", F.lit(0)) <= F.col("s.start")) & F.coalesce(F.col("_next") >= F.col("s.end"), F.lit(True))
    listed = around.where(base | ((F.col("s.verdict") == "live") & clear)).groupBy("_row").agg(
        F.array_sort(F.collect_list("s")).alias("secrets"))
    some = rows.where(F.size("_found") > 0).join(listed, "_row", "left")
    none = rows.where(F.size("_found") == 0).withColumn("secrets", F.lit(None).cast(listed.schema["secrets"].dataType))
    fields = "array<struct<start:int,end:int,kind:string,verdict:string,n_owners:bigint,n_repositories:bigint>>"
    out = some.select(*none.columns).unionByName(none)
    plain = F.transform(F.coalesce("secrets", F.array().cast(listed.schema["secrets"].dataType)), lambda s: F.struct(
        s["start"].alias("start"), s["end"].alias("end"), s["kind"].alias("kind"), s["verdict"].alias("verdict"),
        s["n_owners"].alias("n_owners"), s["n_repositories"].alias("n_repositories")))
    return out.select(*[F.col(f"_keep_{i}").alias(c) for i, c in enumerate(keep)], plain.cast(fields).alias(into))


def redact(text: Column, secrets: Column) -> Column:
    """``text`` with each span replaced by ``<kind:verdict>``; overlapping spans by that of the first."""
    def part(run: Column, begin: Column, end: Column) -> Column:
        """The text from ``begin``, where the spans before have ended, to ``end``, where those of the run have."""
        return _let(F.substring(text, begin + 1, end - begin), lambda piece: F.aggregate(
            run, F.struct(begin.alias("at"), F.lit("").alias("out")),
            lambda s, m: F.struct(
                F.greatest(s["at"], m["end"]).alias("at"),
                F.when(m["start"] >= s["at"], F.concat(
                    s["out"], F.substring(piece, s["at"] - begin + 1, m["start"] - s["at"]), F.lit("<"), m["kind"], F.lit(":"), m["verdict"],
                    F.lit(">"))).otherwise(s["out"]).alias("out")),
            lambda s: s["out"]))

    def joined(runs: Column, reach: Column) -> Column:
        parts = F.transform(runs, lambda run, i: part(run, F.element_at(reach, i + 1), F.element_at(reach, i + 2)))
        return F.concat(F.array_join(parts, ""), F.substring(text, F.element_at(reach, -1) + 1, F.length(text)))

    ends = lambda runs: F.transform(runs, lambda run: F.array_max(F.transform(run, lambda m: m["end"])))
    done = _let(_runs(secrets), lambda runs: _let(_running(ends(runs), F.greatest), lambda reach: joined(runs, reach)))
    return F.when(F.size(secrets) > 0, done).otherwise(text)


def redact_documents(docs: DataFrame, text: str = "text", **how) -> DataFrame:
    """``docs`` with all spans redacted; columns as before, whatever their names, ``n_chars`` (if there is one) counted anew.

    Null texts stay null, texts without spans as they are; repeated rows stay repeated; an empty table stays empty.
    """
    into = "_spans"
    while into in docs.columns:
        into = f"_{into}"
    out = find_secrets(docs, text=text, into=into, **how)
    out = out.withColumn(text, redact(F.col(text), F.col(into)))
    if "n_chars" in docs.columns:
        out = out.withColumn("n_chars", F.when(F.size(into) > 0, F.length(text).cast("long")).otherwise(F.col("n_chars")))
    return out.select(*docs.columns)


def digest(spans: Column, kinds: tuple[str, ...] = KINDS) -> Column:
    """kind:start:end of the spans of some kinds, comma-joined."""
    return F.array_join(F.transform(F.filter(spans, lambda s: s["kind"].isin(*kinds)),
                                    lambda s: F.concat_ws(":", s["kind"], s["start"], s["end"])), ",")


def spans_of(docs: DataFrame) -> DataFrame:
    """The result columns of the registered query."""
    count = lambda kind: F.size(F.filter("secrets", lambda s: s["kind"] == kind)).cast("long")
    return find_secrets(docs, keep=["doc_id"]).select(
        "doc_id", count("assign").alias("n_assign"), count("access").alias("n_access"), count("hex").alias("n_hex"),
        F.sha2(digest(F.col("secrets"), BASE), 256).alias("base_sha256"), digest(F.col("secrets")).alias("spans"),
        F.size(F.filter("secrets", lambda s: s["verdict"] == "live")).cast("long").alias("n_live"))
