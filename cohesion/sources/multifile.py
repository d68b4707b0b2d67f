"""Per-entity sources: a primary file joined with secondary files.

``entity.source_files: {primary, secondary: [{file, join_on, join_type, columns}]}``.
Joins are equi-joins on the key columns with null-safe equality (a null key
matches a null key). No broadcast is forced: AQE measures each side at run
time and broadcasts only a side under ``spark.sql.autoBroadcastJoinThreshold``,
otherwise it plans a sort-merge join and splits skewed partitions.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions import types as TY
from ..functions.predicates import SpecError
from ..session import stored, telling_case
from .readers import ORD, find_entity_file, read_file

SUFFIX = "_secondary"


def _c(n: str) -> Column:
    return F.expr("`" + n.replace("`", "``") + "`")


def union_by_name(frames: list[DataFrame]) -> DataFrame:
    """Stack files by column name, filling missing columns with null. Types are
    widened first: int+double -> double, number+text -> text."""
    fams: dict[str, str] = {}
    for f in frames:
        for fld in f.schema.fields:
            if fld.name == ORD:
                continue
            fams[fld.name] = TY.common_family(fams.get(fld.name, TY.NULL), TY.family(fld.dataType))
    aligned = []
    for f in frames:
        own = {fld.name: TY.family(fld.dataType) for fld in f.schema.fields}
        cols = []
        for name, fam in fams.items():
            if name in own:
                cols.append(TY.to_family(_c(name), own[name], fam).cast(TY.spark_type(fam)).alias(name))
            else:
                cols.append(F.lit(None).cast(TY.spark_type(fam)).alias(name))
        if ORD in f.columns:
            cols.append(F.col(ORD))
        aligned.append(f.select(*cols))
    return reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), aligned)


#: Pairs of rows of one key that a task makes. A key with more of them, and with at least 1/HOT of a side's rows, is split; so
#: the list of such keys, which is broadcast, has at most 2 * HOT entries.
PART_PAIRS = 100_000_000
HOT = 10_000
#: About so many parts are made of one key at most, and beyond them the parts grow. The rows of a key are copied to a row or a column of
#: parts, 2 * sqrt(parts * left rows * right rows) copies in all: with a bound on the parts they grow as the input, without it as its pairs.
PARTS = 4096
#: So many rows of a split key travel and are joined as one. A multiple of eight, so that a column in which a pack comes again and again
#: is the same bytes again and again. The rows of a part are gathered GATHER at a time before they are packed.
PACK = 128
GATHER = 8 * PACK


def key_counts(left: DataFrame, right: DataFrame, on: list[str], nulls_match: bool = True) -> DataFrame:
    """(keys, nl, nr): the rows of each key on both sides, and in ``meet`` whether such rows match. One aggregation for each side."""
    sides = [df.select(*[_c(k).alias(f"__k{i}") for i, k in enumerate(on)]).groupBy(*[f"__k{i}" for i in range(len(on))]).agg(F.count(F.lit(1)).alias(n)) for df, n in ((left, "nl"), (right, "nr"))]
    keys = [f"__k{i}" for i in range(len(on))]
    r = sides[1].withColumnsRenamed({k: f"{k}r" for k in keys})
    both = sides[0].join(r, reduce(lambda a, b: a & b, [F.col(k).eqNullSafe(F.col(f"{k}r")) for k in keys]), "full_outer")
    meet = F.col("nl").isNotNull() & F.col("nr").isNotNull()
    if not nulls_match:
        meet = meet & reduce(lambda a, b: a & b, [F.col(k).isNotNull() for k in keys])
    return both.select(*[F.coalesce(k, f"{k}r").alias(k) for k in keys], F.coalesce("nl", F.lit(0)).alias("nl"), F.coalesce("nr", F.lit(0)).alias("nr"), F.coalesce(meet, F.lit(False)).alias("meet"))


def expected_rows(left: DataFrame, right: DataFrame, on: list[str], how: str = "left", nulls_match: bool = True) -> DataFrame:
    """What a join would give, without joining the rows: left_rows, right_rows, out_rows, and largest_key, the most rows out of one key."""
    c = key_counts(left, right, on, nulls_match)
    pairs = F.when(F.col("meet"), F.col("nl").cast("decimal(38,0)") * F.col("nr")).otherwise(F.lit(0))
    alone = {"inner": F.lit(0), "left": F.when(~F.col("meet"), F.col("nl")).otherwise(0), "right": F.when(~F.col("meet"), F.col("nr")).otherwise(0),
             "full_outer": F.when(~F.col("meet"), F.col("nl") + F.col("nr")).otherwise(0)}[how]
    out = pairs + alone
    total = lambda x: F.coalesce(F.sum(x), F.lit(0)).cast("long")
    return c.agg(total("nl").alias("left_rows"), total("nr").alias("right_rows"), total(out).alias("out_rows"), F.coalesce(F.max(out), F.lit(0)).cast("long").alias("largest_key"))


def _hot_keys(left: DataFrame, right: DataFrame, on: list[str], nulls_match: bool, pairs: int) -> DataFrame:
    """(keys, __h, __a, __b, __g, __n): a key's number, into how many parts the rows of a key with more than ``pairs`` are dealt on the left
    and on the right, in how many groups a part's rows are packed, and the key's pairs. 2 * HOT rows at most.
    A part has ``pairs`` of them, or as many more as leave the key about PARTS parts."""
    c = key_counts(left, right, on, nulls_match)
    share = c.agg(F.sum("nl").alias("l"), F.sum("nr").alias("r")).first()  # two numbers
    least = max(1, int(pairs**0.5))
    made = F.col("nl").cast("double") * F.col("nr")
    side = F.greatest(F.lit(float(least)), F.sqrt(made / PARTS))
    large = F.col("meet") & (made > pairs) & ((F.col("nl") * HOT >= (share["l"] or 0)) | (F.col("nr") * HOT >= (share["r"] or 0)))
    parts = lambda n: F.ceil(F.col(n) / side).cast("int")
    return c.where(large).select(*[f"__k{i}" for i in range(len(on))], F.monotonically_increasing_id().alias("__h"), parts("nl").alias("__a"), parts("nr").alias("__b"),
                                 F.ceil(side / GATHER).cast("long").alias("__g"), made.alias("__n"))


def _dealt(df: DataFrame, keys: list[str], hot: DataFrame, own: str, other: str, own_parts: str, other_parts: str) -> DataFrame:
    """The rows of hot keys in packs (``__rows``), each pack in one part of its own side and once for every part of the other."""
    row = F.xxhash64(F.col(ORD)) if ORD in df.columns else F.xxhash64(F.monotonically_increasing_id())
    match = reduce(lambda a, b: a & b, [_c(k).eqNullSafe(F.col(f"__k{i}")) for i, k in enumerate(keys)])
    # the part is taken before the copies are made, so that all copies of a row are of one part
    placed = df.join(F.broadcast(hot), match).withColumn("__row", row).withColumn(own, F.pmod("__row", F.col(own_parts)).cast("int"))
    groups = ["__h", own, other_parts]
    gathered = placed.groupBy(*groups, F.pmod(F.xxhash64("__row"), F.col("__g"))).agg(F.collect_list(F.struct(*[_c(c) for c in df.columns])).alias("__rows"))
    packs = F.transform(F.sequence(F.lit(1), F.size("__rows"), F.lit(PACK)), lambda at: F.slice("__rows", at, PACK))
    packed = gathered.select(*groups, F.explode(packs).alias("__rows"))
    return packed.select("__h", own, F.explode(F.sequence(F.lit(0), F.col(other_parts) - 1)).alias(other), "__rows")


def _join(left: DataFrame, right: DataFrame, on: list[str], right_on: list[str], nulls_match: bool, how: str, split: bool | int) -> DataFrame:
    conds = [(_c(k).eqNullSafe(_c(r)) if nulls_match else _c(k) == _c(r)) for k, r in zip(on, right_on)]
    plain = lambda a, b: a.join(b, reduce(lambda x, y: x & y, conds), how)
    if not split:
        return plain(left, right)
    hot = stored(_hot_keys(left, right.withColumnsRenamed(dict(zip(right_on, on))) if on != right_on else right, on, nulls_match, PART_PAIRS if split is True else split), "hot-keys")
    told = hot.agg(F.sum(F.col("__a").cast("long") * F.col("__b")).alias("parts"), F.sum("__n").alias("pairs")).first()  # two numbers
    if told["parts"] is None:
        return plain(left, right)
    # rows of hot keys have a match on the other side, so for them every kind of join is an inner one
    names = [f"__k{i}" for i in range(len(on))]
    apart = lambda df, keys: df.join(F.broadcast(hot.select(*names)), reduce(lambda a, b: a & b, [_c(k).eqNullSafe(F.col(n)) for k, n in zip(keys, names)]), "left_anti")
    light = plain(apart(left, on), apart(right, right_on))
    l_packs = _dealt(left, on, hot, "__i", "__j", "__a", "__b")
    r_packs = _dealt(right, right_on, hot, "__rj", "__ri", "__b", "__a").withColumnsRenamed({"__h": "__rh", "__rows": "__r_rows"})
    # packs are small against the pairs that they make: tasks are as many as the pairs ask for, not as their bytes do, and no side is broadcast
    n = min(told["parts"], max(int(left.sparkSession.conf.get("spark.sql.shuffle.partitions")), min(int(told["pairs"] / PART_PAIRS), 4 * PARTS)))
    l_packs, r_packs = l_packs.repartition(n, "__h", "__j", "__i"), r_packs.repartition(n, "__rh", "__rj", "__ri")
    pairs = l_packs.hint("merge").join(r_packs, (F.col("__h") == F.col("__rh")) & (F.col("__j") == F.col("__rj")) & (F.col("__i") == F.col("__ri")))
    # rows come out block by block, each row of a left pack with all of the right pack: a column of the left stays, one of the right goes round.
    # transform() has no generated code, so a row of the left passes on before the next: one loop over both packs and the join would keep
    # all that a left pack makes, 128 times a part's rows
    lefts = pairs.select(F.inline(F.transform("__rows", lambda row: row)), "__r_rows")
    return light.unionByName(lefts.select(*[_c(c) for c in left.columns], F.inline("__r_rows")))


def join_sources(left: DataFrame, right: DataFrame, on: list[str], how: str = "left",
                 columns: list[str] | None = None, nulls_match: bool = True, n_joined: int = 1, split: bool | int = False) -> DataFrame:
    """Equi-join on ``on``; clashing non-key right columns get ``_secondary``
    (``_secondary2``... on later clashes). Keys come out once, coalesced.
    ``split``: count the keys first, and deal the rows of a key with many on both sides (null ids match null ids) into parts, left times right, of PART_PAIRS pairs or as many as ``split`` says."""
    for k in on:
        if k not in left.columns or k not in right.columns:
            raise SpecError(f"join key {k!r} missing")
        lf, rf = TY.family(left.schema[k].dataType), TY.family(right.schema[k].dataType)
        if (lf == TY.STRING) != (rf == TY.STRING) and TY.NULL not in (lf, rf):
            raise SpecError(f"join key {k!r}: text on one side, number on the other")
    if columns is not None:
        missing = [c for c in columns if c not in right.columns]
        if missing:
            raise SpecError(f"secondary columns not found: {missing}")
        keep = list(on) + [c for c in columns if c not in on]
    else:
        keep = [c for c in right.columns if c != ORD]
    has_r_ord = ORD in right.columns
    r_ord = right[ORD] if has_r_ord else F.lit(None)
    right = right.select(*[_c(c) for c in keep], r_ord.alias("__r_ord"))
    ren = {}
    for c in keep:
        if c in on:
            ren[c] = f"__rk_{c}"
        elif c in left.columns:
            name = c + SUFFIX
            i = 2
            while name in left.columns or name in ren.values():
                name = f"{c}{SUFFIX}{i}"
                i += 1
            ren[c] = name
    right = right.withColumnsRenamed(ren)
    j = _join(left, right, on, [f"__rk_{k}" for k in on], nulls_match, how, split)
    out = []
    for c in left.columns:
        if c == ORD:
            continue
        if c in on:
            out.append(F.coalesce(_c(c), _c(f"__rk_{c}")).alias(c))
        else:
            out.append(_c(c))
    for c in keep:
        if c not in on:
            out.append(_c(ren.get(c, c)))
    if ORD in left.columns or has_r_ord:
        l_ord = F.col(ORD) if ORD in left.columns else F.lit(None)
        out.append(F.struct(l_ord.alias("l"), F.col("__r_ord").alias("r")).alias(ORD))
    return j.select(*out)


def load_entity_sources(spark: SparkSession, directory: str, entity: str, source_files: dict | None,
                        int_with_nulls: str = "double", bad_rows: str | None = None) -> DataFrame:
    """A7/A8 + C12 + D1-D8: the joined source table of one entity. ``bad_rows``: as in ``read_file``."""
    base = directory.rstrip("/")
    if not source_files:
        return read_file(spark, find_entity_file(spark, directory, entity), 0, int_with_nulls, bad_rows=bad_rows)
    ml = source_files.get("multi_line")
    df = read_file(spark, f"{base}/{source_files['primary']}", 0, int_with_nulls, multi_line=ml, bad_rows=bad_rows)
    idx = 1
    for n, sec in enumerate(source_files.get("secondary") or [], start=1):
        files = sec["file"] if isinstance(sec["file"], list) else [sec["file"]]
        frames = []
        for f in files:
            frames.append(read_file(spark, f"{base}/{f}", idx, int_with_nulls, multi_line=ml, bad_rows=bad_rows))
            idx += 1
        with telling_case(spark, [c for f in frames for c in f.columns]):
            right = frames[0] if len(frames) == 1 else union_by_name(frames)
        how = {"left": "left", "right": "right", "inner": "inner", "outer": "full_outer"}[sec["join_type"]]
        with telling_case(spark, [*df.columns, *right.columns]):
            df = join_sources(df, right, sec["join_on"], how, sec.get("columns"),
                              nulls_match=sec.get("nulls_match", True), n_joined=n, split=True)
    return df
