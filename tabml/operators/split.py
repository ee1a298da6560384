"""Exact splits, folds and resampling without sorting or moving the rows.

A row's place in the random order is the md5 of the seed and its key (the key columns
must identify a row). ``rank_cuts`` finds the md5 at the wanted rank of each class;
after that a split is one comparison per row.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tabml.functions.ordered import class_sizes, digest_levels, rank_cuts
from tabml.functions.scalars import hash_fraction
from tabml.operators.neighbours import nearest, spreads
from tabml.session import staged



@dataclass(frozen=True)
class SplitOptions:
    key: tuple[str, ...]
    method: str = "stratified"
    label: str | None = None
    timestamp: str | None = None
    test_size: float = 0.15
    val_size: float = 0.15
    seed: int = 42

    def counts(self, n: int) -> tuple[int, int]:
        """Test and validation rows out of n (half to even)."""
        test = round(n * self.test_size)
        val = round((n - test) * self.val_size / max(1e-9, 1 - self.test_size))
        return test, val


def split_method(plan: str | None, config: str | None, task: str) -> str:
    """Plan before configuration before a default by task."""
    return plan or config or ("stratified" if task in ("binary", "multiclass") else "random")


def digest(key: tuple[str, ...], seed: int) -> Column:
    return F.md5(F.concat_ws("-", F.lit(str(seed)), *[F.col(c).cast("string") for c in key]))


def order_text(key: tuple[str, ...], seed: int) -> Column:
    """The digest, and the key behind it in case two digests are equal."""
    return F.concat_ws("-", digest(key, seed), *[F.col(c).cast("string") for c in key])


def _cuts(df: DataFrame, label: Column, key: tuple[str, ...], seed: int, targets: list) -> dict:
    """(label, rank) -> order text of the row at that rank."""
    found = rank_cuts(
        df, label, digest_levels(digest(key, seed)), order_text(key, seed), targets
    )
    return {k: v[-1] for k, v in found.items()}


def _with_class_values(df: DataFrame, label: Column, rows: list[tuple], fields: str) -> DataFrame:
    """Attach one local row per class; ``class_sizes`` has bounded their number."""
    kind = df.select(label.alias("l")).schema["l"].dataType.simpleString()
    local = df.sparkSession.createDataFrame(rows, f"_label {kind}, {fields}")
    return df.withColumn("_l", label).join(
        F.broadcast(local), F.col("_l").eqNullSafe(F.col("_label")), "left"
    ).drop("_l", "_label")


def stratified_split(df: DataFrame, opts: SplitOptions) -> DataFrame:
    """Adds ``split``; every class is divided in the same shares, to the row.

    With fewer than two classes, or a class of one row, all rows form one class.
    """
    label = F.col(opts.label)
    sizes = class_sizes(df, label)
    if len(sizes) < 2 or min(sizes.values()) < 2:
        label = F.lit("all")
        sizes = {"all": sum(sizes.values())}
    wanted = {}
    for value, n in sizes.items():
        test, val = opts.counts(n)
        wanted[value] = (test, test + val)
    targets = [(value, rank) for value, ranks in wanted.items() for rank in set(ranks)]
    cuts = _cuts(df, label, opts.key, opts.seed, targets)
    rows = [(v, cuts.get((v, a)), cuts.get((v, b))) for v, (a, b) in wanted.items()]
    place = order_text(opts.key, opts.seed)
    return (
        _with_class_values(df, label, rows, "_test string, _val string")
        .withColumn(
            "split",
            F.when(place <= F.col("_test"), "test").when(place <= F.col("_val"), "val").otherwise("train"),
        )
        .drop("_test", "_val")
    )


def random_split(df: DataFrame, opts: SplitOptions) -> DataFrame:
    """Adds ``split`` by the digest alone: no pass over the data, shares are approximate."""

    def edge(share: float) -> str:
        return f"{min(int(share * 2**32), 2**32 - 1):08x}"

    d = digest(opts.key, opts.seed)
    return df.withColumn(
        "split",
        F.when(d < edge(opts.test_size), "test")
        .when(d < edge(opts.test_size + opts.val_size), "val")
        .otherwise("train"),
    )


def time_split(df: DataFrame, opts: SplitOptions) -> DataFrame:
    """Adds ``split``: the latest rows are the test set, those before them validation.

    Rows without a time count as latest; equal times are ordered by the key's digest.
    """
    if not opts.timestamp:
        raise ValueError("a time split needs a timestamp column")
    hour = 3_600_000_000
    late = 2**62
    micros = F.unix_micros(F.col(opts.timestamp).cast("timestamp"))
    at = F.coalesce(micros, F.lit(late))
    d = digest(opts.key, opts.seed)
    inside = F.pmod(at, F.lit(hour))
    levels = [
        (at - inside) / hour,
        F.floor(inside / 1000),
        F.concat(F.lpad((at % 1000).cast("string"), 3, "0"), F.substring(d, 1, 2)),
        F.substring(d, 3, 4),
    ]
    place = order_text(opts.key, opts.seed)
    n = df.count()
    test, val = opts.counts(n)
    ranks = [n - test - val, n - test]
    found = rank_cuts(
        df, F.lit(1), levels, F.struct(at.alias("t"), place.alias("k")), [(1, r) for r in set(ranks)]
    )

    def upto(rank: int) -> Column:
        if rank <= 0:
            return F.lit(False)
        cut = found[(1, rank)][-1]
        return (at < cut["t"]) | ((at == cut["t"]) & (place <= cut["k"]))

    return df.withColumn(
        "split", F.when(upto(ranks[0]), "train").when(upto(ranks[1]), "val").otherwise("test")
    )


def split_rows(df: DataFrame, opts: SplitOptions) -> DataFrame:
    if opts.method == "time":
        return time_split(df, opts)
    if opts.method == "stratified" and opts.label:
        return stratified_split(df, opts)
    return random_split(df, opts)


def stratified_folds(
    df: DataFrame, label: str, key: tuple[str, ...], k: int = 5, seed: int = 42
) -> DataFrame:
    """Adds ``fold`` 0..k-1; fold sizes differ by at most one row per class."""
    sizes = class_sizes(df, F.col(label))
    wanted = {v: [n * i // k for i in range(1, k)] for v, n in sizes.items()}
    targets = [(v, r) for v, ranks in wanted.items() for r in set(ranks)]
    cuts = _cuts(df, F.col(label), key, seed, targets)
    # rank 0 has no row: its cut is below every digest
    rows = [(v, [cuts.get((v, r), "") for r in ranks]) for v, ranks in wanted.items()]
    place = order_text(key, seed)
    return (
        _with_class_values(df, F.col(label), rows, "_cuts array<string>")
        .withColumn("fold", F.size(F.filter("_cuts", lambda c: c < place)))
        .drop("_cuts")
    )


# ---------------------------------------------------------------- class balance


def undersample(
    df: DataFrame, label: str, key: tuple[str, ...], ratio: float = 0.3, seed: int = 42
) -> DataFrame:
    """Keep of each larger class so many rows that the rarest makes ``ratio`` of it."""
    sizes = class_sizes(df, F.col(label))
    if not sizes:
        return df
    rare = min(sizes.values())
    keep = {v: min(n, round(rare / ratio)) for v, n in sizes.items()}
    shrunk = [(v, r) for v, r in keep.items() if r < sizes[v]]
    cuts = _cuts(df, F.col(label), key, seed, shrunk)
    rows = [(v, cuts.get((v, r))) for v, r in keep.items()]
    return (
        _with_class_values(df, F.col(label), rows, "_cut string")
        .filter(F.col("_cut").isNull() | (order_text(key, seed) <= F.col("_cut")))
        .drop("_cut")
    )


def oversample(
    df: DataFrame, label: str, key: tuple[str, ...], ratio: float = 0.3, seed: int = 42
) -> DataFrame:
    """Repeat the rows of smaller classes up to ``ratio`` of the largest; adds ``copy``."""
    sizes = class_sizes(df, F.col(label))
    if not sizes:
        return df.withColumn("copy", F.lit(1))
    goal = round(max(sizes.values()) * ratio)
    plan = {v: divmod(max(goal, n), n) for v, n in sizes.items()}
    cuts = _cuts(df, F.col(label), key, seed, [(v, extra) for v, (_, extra) in plan.items()])
    rows = [(v, times, cuts.get((v, extra))) for v, (times, extra) in plan.items()]
    once_more = F.coalesce((order_text(key, seed) <= F.col("_cut")).cast("int"), F.lit(0))
    return (
        _with_class_values(df, F.col(label), rows, "_times int, _cut string")
        .withColumn("copy", F.explode(F.sequence(F.lit(1), F.col("_times") + once_more)))
        .drop("_times", "_cut")
    )


def synthetic_rows(
    df: DataFrame,
    label: str,
    key: tuple[str, ...],
    columns: list[str],
    ratio: float = 0.3,
    seed: int = 42,
    neighbours: int = 5,
) -> DataFrame:
    """New rows of the rarest class, up to ``ratio`` of the largest, between neighbours.

    A new row lies between a row and one of its nearest ``neighbours`` in the class, by distance over
    the columns divided by their deviations; which one, and where between, is drawn from the row's place and
    the copy's number. Rows with a missing column have no neighbours and are not copied; a class of one
    row gives copies of it. Returns the columns, the label and ``copy``.
    """
    sizes = class_sizes(df, F.col(label))
    if not sizes:
        return df.select(*columns, label, F.lit(1).alias("copy"))
    rare = min(sizes, key=lambda v: (sizes[v], str(v)))
    few = df.filter(F.col(label).eqNullSafe(F.lit(rare))).dropna(subset=columns)
    few = staged(few.select(*[F.col(f"`{c}`") for c in dict.fromkeys([*key, *columns, label])]), "rare-class")
    n = few.count()
    missing = max(round(max(sizes.values()) * ratio) - sizes[rare], 0)
    times, extra = divmod(missing, max(n, 1))
    cut = _cuts(few, F.lit(1), key, seed, [(1, extra)]).get((1, extra), "")
    copies = F.lit(times) + (F.col("_place") <= F.lit(cut)).cast("int")
    found = nearest(few, order_text(key, seed), columns, F.lit(None), neighbours, spreads(few, columns), named=False)
    found = found.withColumn("_copies", copies).filter("_copies > 0")
    found = found.withColumn("copy", F.explode(F.sequence(F.lit(1), F.col("_copies"))))
    number = F.col("copy").cast("string")
    pick = F.floor(hash_fraction(F.md5(F.concat_ws("-", F.lit("near"), "_place", number))) * F.size("near")).cast("int")
    share = hash_fraction(F.md5(F.concat_ws("-", "_place", number)))
    found = found.withColumn("_near", F.get("near", pick)["at"])

    def between(i: int, c: str) -> Column:
        here = F.col(f"`{c}`").cast("double")
        return (here + (F.coalesce(F.get("_near", F.lit(i)), here) - here) * share).alias(c)

    return found.select(*[between(i, c) for i, c in enumerate(columns)], label, "copy")


def cleaned(
    df: DataFrame, label: str, key: tuple[str, ...], columns: list[str], neighbours: int = 3, seed: int = 42
) -> DataFrame:
    """The rows that at least half of their nearest ``neighbours``, of any class, agree with.

    Neighbours as in ``synthetic_rows``; rows with a missing column have none and stay. A NULL label
    is a class.
    """
    own = F.coalesce(F.concat(F.lit("="), F.col(label).cast("string")), F.lit("null"))
    found = nearest(df, order_text(key, seed), columns, own, neighbours, spreads(df.dropna(subset=columns), columns), named=False)
    against = F.size(F.filter("near", lambda x: x["load"] != own))
    return found.filter(2 * against <= F.size("near")).select(*[F.col(f"`{c}`") for c in df.columns])
