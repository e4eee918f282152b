"""Near-duplicate vectors by PCA-ordered tiled comparison."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from subsight.llm.graph import components
from subsight.llm.tables import stored

THRESHOLD = 0.93
#: Vectors of a tile, about; a pair of tiles is one unit of work.
TILE = 2048
#: Tiles of a block, at most. A tile is sent to a block pair once, whatever the number of its partners there.
BLOCK = 8
#: The principal axes and tile borders are fitted on about so many vectors; results do not depend on them.
SAMPLE = 16384
#: Axes whose ranges bound a tile.
BOX_AXES = 8
#: Leading axes summed before each bound is tested.
STEPS = (16, 32)
_SLACK = 1e-9


def unit_rows(x: np.ndarray) -> np.ndarray:
    """Rows scaled to length one in double precision, without overflow."""
    x = x.astype(np.float64)
    x = x / np.abs(x).max(axis=1, keepdims=True)
    return x / np.sqrt(np.einsum("ij,ij->i", x, x))[:, None]


def linked(a: np.ndarray, b: np.ndarray, axes: np.ndarray, threshold: float) -> np.ndarray:
    """Which unit rows of ``a`` and ``b`` have a cosine of at least ``threshold``.

    Products are summed over the leading principal axes first. What the rest
    can add is at most the product of the two suffix norms, so rows and
    columns of which no pair can still reach the threshold are left out of
    the next, wider sum; the survivors are decided by the full product of
    the vectors themselves.
    """
    rows, cols = np.arange(len(a)), np.arange(len(b))
    pa_, pb = a @ axes, b @ axes
    total, at = np.zeros((len(a), len(b))), 0
    for end in STEPS:
        if end >= axes.shape[1] or not len(rows):
            break
        total += pa_[rows, at:end] @ pb[cols, at:end].T
        left_a, left_b = (np.sqrt(np.maximum(1 - np.einsum("ij,ij->i", x[:, :end], x[:, :end]), 0)) for x in (pa_[rows], pb[cols]))
        open_ = total + left_a[:, None] * left_b[None, :] >= threshold - _SLACK
        keep_r, keep_c = open_.any(axis=1), open_.any(axis=0)
        rows, cols, total, at = rows[keep_r], cols[keep_c], total[np.ix_(keep_r, keep_c)], end
    out = np.zeros((len(a), len(b)), bool)
    if len(rows) and len(cols):
        out[np.ix_(rows, cols)] = a[rows] @ b[cols].T >= threshold
    return out


def _roots(i: np.ndarray, j: np.ndarray, n: int) -> np.ndarray:
    """The least node reachable from each of ``n`` nodes over the edges i - j."""
    root = np.arange(n)
    while True:
        low = np.minimum(root[i], root[j])
        new = root.copy()
        np.minimum.at(new, i, low)
        np.minimum.at(new, j, low)
        new = new[new]
        if (new == root).all():
            return root
        root = new


def _clean(vectors: DataFrame, id_col: str, vec_col: str, label_col: str) -> DataFrame:
    v = F.col("v")
    bad = F.exists(v, lambda x: x.isNull() | F.isnan(x) | (F.abs(x) == float("inf")))
    usable = F.col("label").isNotNull() & v.isNotNull() & ~F.coalesce(bad, F.lit(False)) & F.exists(v, lambda x: x != 0)
    rows = vectors.select(F.col(id_col).cast("long").alias("id"), F.col(label_col).alias("label"), F.col(vec_col).alias("v"))
    return rows.withColumn("usable", F.coalesce(usable, F.lit(False)))


def _pack(rows: DataFrame, dtype: str) -> DataFrame:
    """One row per tile: its class ids, multiplicities and vectors as bytes."""
    def run(table: pa.Table) -> pa.Table:
        flat = table["v"].combine_chunks().flatten().to_numpy(zero_copy_only=False).astype(dtype)
        return pa.table({"tile": table["tile"][:1], "cids": [table["cid"].to_numpy().astype("<i8").tobytes()],
                         "copies": [table["copies"].to_numpy().astype("<i8").tobytes()], "data": [flat.tobytes()]},
                        schema=pa.schema([("tile", pa.string()), ("cids", pa.binary()), ("copies", pa.binary()), ("data", pa.binary())]))

    return rows.select("tile", "cid", "copies", "v").groupBy("tile").applyInArrow(run, "tile string, cids binary, copies binary, data binary")


def _sends(pairs: DataFrame) -> DataFrame:
    """What each pair of blocks needs: ``(g1, g2, dim, side, tile, ones)`` from ``pairs(g1, g2, dim, one, two)``.

    On side 0 the tiles of the first block, on side 1 those of the second
    with their partners in the first. A block has at most ``BLOCK`` tiles, so
    with all pairs of tiles to be compared a pair costs 2 / ``BLOCK`` tiles
    sent, not two.
    """
    first = pairs.select("g1", "g2", "dim", F.lit(0).alias("side"), F.col("one").alias("tile")).distinct() \
        .withColumn("ones", F.array().cast("array<string>"))
    second = pairs.groupBy("g1", "g2", "dim", F.lit(1).alias("side"), F.col("two").alias("tile")).agg(F.collect_list("one").alias("ones"))
    return first.unionByName(second)


def _projector(axes: dict[int, np.ndarray], k: int, dtype: str):
    """Adds the first ``k`` principal coordinates of each vector, as ``p``."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            out: list = [None] * b.num_rows
            dims = b.column(b.schema.get_field_index("dim")).to_numpy(zero_copy_only=False)
            vecs = b.column(b.schema.get_field_index("v"))
            for d in np.unique(dims):
                at = np.flatnonzero(dims == d)
                x = vecs.take(pa.array(at)).flatten().to_numpy(zero_copy_only=False).reshape(len(at), d)
                p = unit_rows(x) @ axes[int(d)][:, :k]
                for i, row in zip(at, p.tolist()):
                    out[i] = row
            yield pa.RecordBatch.from_arrays([*b.columns, pa.array(out, pa.list_(pa.float64()))], [*b.schema.names, "p"])

    return run


def embedding_components(vectors: DataFrame, threshold: float = THRESHOLD, tile: int = TILE, id_col: str = "vec_id",
                         vec_col: str = "embedding", label_col: str = "label") -> DataFrame:
    """``(id_col, n_links, component_id, kept)``, one row per row of ``vectors``.

    Vectors of equal, non-null label and equal length link at a cosine of at
    least ``threshold`` (over 0), in double precision. Equal vectors are one
    class with a multiplicity. Classes are cut into tiles along the first
    principal axis (crowded stretches are split by hash, so no tile grows
    with a group), and pairs of tiles whose boxes over the leading axes are
    near enough are compared. Tiles form blocks of at most ``BLOCK``; a task
    that compares two blocks holds the tiles of the first and reads those of
    the second one by one. A pair
    gives back at most one row per class: its number of links and the least
    class it reaches within the pair. So links are counted without being
    listed, and components follow from these edges.

    Rows whose vector or label is null, zero, or holds null or non-finite
    components, link with nothing: 0 links, their own component, kept. Ties
    and repeated rows count as other vectors; a component of null ids has a
    null id and is kept. An empty table gives an empty result; other columns
    are not read.
    """
    if not 0 < threshold <= 1:
        raise ValueError("threshold must be in (0, 1]")
    spark = vectors.sparkSession
    dtype = "<f4" if dict(vectors.dtypes)[vec_col] == "array<float>" else "<f8"
    rows = _clean(vectors, id_col, vec_col, label_col)
    classes = rows.where("usable").groupBy("label", "v").agg(F.min("id").alias("rep"), F.count(F.lit(1)).alias("copies")) \
        .select(F.monotonically_increasing_id().alias("cid"), "label", "v", "rep", "copies", F.size("v").alias("dim"))
    classes = stored(classes, "vector-classes")

    counts = {(r["label"], r["dim"]): r["n"] for r in classes.groupBy("label", "dim").agg(F.count(F.lit(1)).alias("n")).collect()}
    share = min(1.0, SAMPLE / max(1, sum(counts.values())))
    sample = classes.where(F.pmod(F.xxhash64("cid"), F.lit(1 << 20)) < share * (1 << 20)).select("label", "dim", "v").toArrow()
    axes: dict[int, np.ndarray] = {}
    borders: dict[tuple, list[float]] = {k: [] for k in counts}  # one bin where the sample has no vector
    dims, labels = sample["dim"].to_numpy(), sample["label"].to_pylist()
    for d in {k[1] for k in counts}:
        at = np.flatnonzero(dims == d)
        if not len(at):
            axes[d] = np.eye(d)
            continue
        x = unit_rows(sample["v"].combine_chunks().take(pa.array(at)).flatten().to_numpy(zero_copy_only=False).reshape(len(at), d))
        axes[d] = np.linalg.eigh(x.T @ x)[1][:, ::-1].copy()
        first = x @ axes[d][:, 0]
        for label in {labels[i] for i in at}:
            mine = np.sort(first[[k for k, i in enumerate(at) if labels[i] == label]])
            bins = min(len(mine), -(-counts[label, d] // tile))
            borders[label, d] = np.unique([mine[len(mine) * b // bins] for b in range(1, bins)]).tolist() if bins > 1 else []
    # Unit vectors whose cosine reaches the threshold are at most so far apart, along any axis and in any subspace.
    far = float(np.sqrt(max(0.0, 2 - 2 * threshold))) + 1e-6
    reach = [(label, d, i, bisect_all(cut, i, far)) for (label, d), cut in borders.items() for i in range(len(cut) + 1)]
    kind = classes.schema["label"].dataType.simpleString()
    bins = spark.createDataFrame([(k[0], k[1], cut) for k, cut in borders.items()], f"label {kind}, dim int, cuts array<double>")
    upto = spark.createDataFrame(reach, f"label {kind}, dim int, bin int, last int")

    k = min(BOX_AXES, max((d for _, d in counts), default=1))
    projected = classes.select("cid", "label", "dim", "copies", "v").mapInArrow(
        _projector(axes, k, dtype), f"cid long, label {kind}, dim int, copies long, v {dict(vectors.dtypes)[vec_col]}, p array<double>")
    binned = projected.join(bins, ["label", "dim"], "left").withColumn(
        "bin", F.coalesce(F.size(F.filter("cuts", lambda c: c <= F.col("p")[0])), F.lit(0))).drop("cuts")
    binned = stored(binned, "vector-bins")
    crowd = binned.groupBy("label", "dim", "bin").agg(F.count(F.lit(1)).alias("n"))
    tiles, part = F.ceil(F.col("n") / tile), F.pmod(F.xxhash64("cid"), F.ceil(F.col("n") / tile))
    several = max(1, BLOCK // 2)  # bins of up to two tiles share a block, others have blocks of their own
    block = F.when(tiles <= 2, F.concat(F.lit("b"), F.floor(F.col("bin") / several))) \
        .otherwise(F.concat_ws("c", "bin", F.floor(part / BLOCK).cast("string")))
    tiled = binned.join(crowd, ["label", "dim", "bin"]) \
        .withColumn("tile", F.concat_ws("/", F.col("label").cast("string"), "dim", "bin", part)) \
        .withColumn("block", F.concat_ws("/", F.col("label").cast("string"), "dim", block))
    boxes = tiled.groupBy("label", "dim", "bin", "block", "tile").agg(
        F.array(*[F.min(F.coalesce(F.get("p", F.lit(i)), F.lit(0.0))) for i in range(k)]).alias("low"),
        F.array(*[F.max(F.coalesce(F.get("p", F.lit(i)), F.lit(0.0))) for i in range(k)]).alias("high"))
    boxes = stored(boxes, "tiles")
    near = boxes.join(upto, ["label", "dim", "bin"]).select(
        "label", "dim", F.col("block").alias("g1"), F.col("tile").alias("one"), F.col("low").alias("low1"), F.col("high").alias("high1"),
        F.col("bin").alias("bin1"), F.explode(F.sequence("bin", "last")).alias("bin"))
    gap = sum((F.pow(F.greatest(F.lit(0.0), F.col("low")[i] - F.col("high1")[i], F.col("low1")[i] - F.col("high")[i]), F.lit(2.0))
               for i in range(k)), F.lit(0.0))
    pairs = near.join(boxes, ["label", "dim", "bin"]).where((F.col("bin1") < F.col("bin")) | (F.col("one") <= F.col("tile"))) \
        .where(gap <= far * far).select("g1", F.col("block").alias("g2"), "dim", "one", F.col("tile").alias("two"))
    packs = stored(_pack(tiled, dtype), "packs")
    work = _sends(stored(pairs, "tile-pairs")).join(packs, "tile").repartition("g1", "g2").sortWithinPartitions("g1", "g2", "side")

    def compare(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        key, held = None, {}
        for b in batches:
            column = {name: b.column(i) for i, name in enumerate(b.schema.names)}
            for r in range(b.num_rows):
                get = lambda c: column[c][r].as_py()
                if (get("g1"), get("g2")) != key:
                    key, held = (get("g1"), get("g2")), {}
                d, two = get("dim"), get("tile")
                mine = (np.frombuffer(get("cids"), "<i8"), np.frombuffer(get("copies"), "<i8"),
                        np.frombuffer(get("data"), dtype).reshape(-1, d))
                if get("side") == 0:
                    held[two] = mine
                    continue
                cid2, n2, x2 = *mine[:2], unit_rows(mine[2])
                for one in get("ones"):
                    same, (cid1, n1, data1) = one == two, held[one]
                    x1 = x2 if same else unit_rows(data1)
                    hit = linked(x1, x2, axes[d], threshold)
                    if same:
                        np.fill_diagonal(hit, False)
                        hit &= hit.T
                        cid, links = cid1, hit @ n1
                        i, j = np.nonzero(hit)
                    else:
                        cid, links = np.concatenate([cid1, cid2]), np.concatenate([hit @ n2, hit.T @ n1])
                        i, j = np.nonzero(hit)
                        j = j + len(cid1)
                    root = _roots(i, j, len(cid))
                    at = np.flatnonzero(links)
                    yield pa.RecordBatch.from_arrays([pa.array(cid[at]), pa.array(links[at].astype(np.int64)), pa.array(cid[root[at]])],
                                                     ["cid", "links", "root"])

    found = stored(work.mapInArrow(compare, "cid long, links long, root long"), "vector-links")
    nodes = components(found.select(F.col("cid").alias("u"), F.col("root").alias("v")))
    least = nodes.join(classes.select(F.col("cid").alias("node"), "rep"), "node").groupBy("root").agg(F.min("rep").alias("least"))
    of = nodes.join(least, "root").select(F.col("node").alias("cid"), "least")
    per = classes.join(found.groupBy("cid").agg(F.sum("links").alias("links")), "cid", "left").join(of, "cid", "left").select(
        F.col("label").alias("clabel"), F.col("v").alias("cv"), (F.coalesce("links", F.lit(0)) + F.col("copies") - 1).alias("n"),
        F.coalesce("least", "rep").alias("component"), F.lit(True).alias("found"))
    per = stored(per, "vector-components")
    out = rows.join(per, F.col("usable") & (rows.label == per.clabel) & (rows.v == per.cv), "left")
    component = F.when(F.col("found"), F.col("component")).otherwise(F.col("id"))
    return out.select(F.col("id").alias(id_col), F.coalesce("n", F.lit(0)).cast("long").alias("n_links"),
                      component.alias("component_id"), F.col("id").eqNullSafe(component).alias("kept"))


def bisect_all(cuts: list[float], i: int, far: float) -> int:
    """The last bin that can hold a vector within ``far`` of bin ``i`` along the first axis."""
    if i >= len(cuts):
        return i
    return int(np.searchsorted(cuts, cuts[i] + far, "right"))
