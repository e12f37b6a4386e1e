"""Exact Jaccard join of documents as a metric-space join, and its connected components.

A document is the set of its word shingles; equal sets are one point. Pivots are one-shingle sets,
ranked by rarity (a fixed-size table of counts over all documents): a point is equally near to each
of its own shingles, and lies in the Voronoi region of the best ranked one. A point linked to it
(distance at most 0.1) lacks at most a tenth of its shingles, so by the triangle inequality that
point's region is among the first tenth (plus one) of its own pivots: into those regions it is
replicated. Every link is inside a region.

Regions are split again. By the size window (a distance to the empty set: linked sizes differ by at
most a tenth) into bands, with replicas in the next band; then by a document pivot, the point with the
fewest rarer shingles: points linked to it are connected through it and need no comparison with each
other; the others are compared with the points whose distance to the pivot differs by at most 0.1.
Positions in the ranked sets bound the overlap of any two points before sets are compared, and so do 128
further pivots, hash classes of all shingles: by the triangle inequality two sets differ in at least as
many shingles as their counts in the classes differ. Points that share a region without being its pivot meet
only if that holds for the parities of 512 finer classes already, a few longs that the join compares itself.
Every remaining pair is decided on the full sets.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import Window

from hirelens.llm.common import bitmap, marked, ragged, sliced, small_batches, stored
from hirelens.llm.words import mix, run_hashes, split_words, word_hashes
from hirelens.sources.tables import read_parquet

COUNT_BITS = 18
# Classes of shingles whose sizes describe a set, and bits of the bitmaps of identifiers and regions.
SHAPE_BITS, MARK_BITS = 7, 26
# Finer classes, of which a set has the parity of its count in each: this many bits, in longs.
PARITY_BITS = 9
PARITIES = [f"parity{i}" for i in range((1 << PARITY_BITS) // 64)]
PARITY_SCHEMA = ", ".join(f"{p} long" for p in PARITIES)
# Text bytes handled at once: their words take many times as much memory.
SLICE = 3 << 20
# Sizes of one band differ by at most this factor; the wider it is, the fewer points lie near a band's end.
BAND = 1.5


def shingle_sets(batch: pa.RecordBatch, size: int) -> tuple[np.ndarray, list[np.ndarray]]:
    """Hashes of all shingles of the batch, and the distinct sorted ones of each row.

    Fewer words than ``size`` give one shingle of all words, no words give none.
    """
    rows = split_words(batch.column("text"), lower=True)
    words, offsets = word_hashes(rows)
    full = run_hashes(words, size)
    sets = []
    for start, stop in zip(offsets[:-1].tolist(), offsets[1:].tolist()):
        found = full[start:stop - size + 1] if stop - start >= size else run_hashes(words[start:stop], stop - start)[:stop > start]
        found = np.sort(found)
        if len(found) > 1:
            found = found[np.concatenate([[True], found[1:] != found[:-1]])]
        sets.append(found)
    return full, sets


def least_overlap(a, b, percent: int):
    """Smallest intersection of sets of these sizes with a Jaccard of at least ``percent`` hundredths."""
    whole = percent * (a + b)
    return F.ceil(whole / F.lit(100 + percent)) if isinstance(a, Column) else -(-whole // (100 + percent))


def shingle_counts(narrow: DataFrame, size: int) -> np.ndarray:
    """How often the shingles of each of 2^18 hash buckets occur in all documents. Fixed size."""
    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros(1 << COUNT_BITS, dtype=np.int64)
        for batch in sliced(batches, "text", SLICE):
            words, offsets = word_hashes(split_words(batch.column("text"), lower=True))
            total += np.bincount((run_hashes(words, size) >> np.uint64(64 - COUNT_BITS)).astype(np.int64),
                                 minlength=1 << COUNT_BITS)
        at = np.flatnonzero(total)
        yield pa.RecordBatch.from_arrays([pa.array(at.astype(np.int32)), pa.array(total[at])], names=["bucket", "n"])

    rows = narrow.select("text").mapInArrow(count, "bucket int, n long").groupBy("bucket").agg(F.sum("n").alias("n")).toPandas()
    counts = np.zeros(1 << COUNT_BITS, dtype=np.int64)
    counts[rows["bucket"].to_numpy()] = rows["n"].to_numpy()
    return counts


def parities(held: np.ndarray) -> np.ndarray:
    """Which of the finer classes hold an odd number of the set's shingles, as longs."""
    counts = np.bincount((held >> np.uint64(64 - PARITY_BITS)).astype(np.int64), minlength=1 << PARITY_BITS)
    return np.packbits((counts & 1).astype(np.uint8)).view(np.int64)


def points(narrow: DataFrame, counts: np.ndarray, size: int, percent: int) -> DataFrame:
    """Per document: doc_id, n (set size), two halves of the set's hash, first ranked shingles, counts and parities by class."""
    steps = np.minimum(8 * np.log2(counts + 1.0), 255).astype(np.uint64) << np.uint64(56)
    shared = narrow.sparkSession.sparkContext.broadcast(steps)

    edges = np.arange(1, 1 << SHAPE_BITS, dtype=np.uint64) << np.uint64(64 - SHAPE_BITS)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        rank = shared.value
        for batch in sliced(batches, "text", SLICE):
            _, sets = shingle_sets(batch, size)
            prefixes = []
            for held in sets:
                # Rarity step, then hash: one order for all documents.
                ranked = rank[held >> np.uint64(64 - COUNT_BITS)] | (held >> np.uint64(8))
                keep = len(held) - -(-percent * len(held) // 100) + 1 if len(held) else 0
                ranked = np.partition(ranked, keep - 1)[:keep] if 0 < keep < len(ranked) else ranked
                prefixes.append(np.sort(ranked).view(np.int64))
            sums = [np.array([int(f(s).sum()) if len(s) else 0 for s in sets], dtype=np.uint64).view(np.int64)
                    for f in (mix, lambda s: mix(s ^ np.uint64(0x5851F42D4C957F2D)))]
            odd = np.array([parities(s) for s in sets], dtype=np.int64).reshape(-1, len(PARITIES))
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc_id"), pa.array([len(s) for s in sets], pa.int64()), *map(pa.array, sums),
                 ragged(prefixes, pa.int64()),
                 ragged([np.minimum(np.diff(np.searchsorted(s, edges), prepend=0, append=len(s)), 32767) for s in sets], pa.int16()),
                 *[pa.array(np.ascontiguousarray(x)) for x in odd.T]],
                names=["doc_id", "n", "key_a", "key_b", "pivots", "shape", *PARITIES])

    return narrow.mapInArrow(
        run, f"doc_id long, n long, key_a long, key_b long, pivots array<long>, shape array<smallint>, {PARITY_SCHEMA}")


def marks(values: DataFrame) -> np.ndarray:
    """Bitmap of fixed size of the hashes of one column. What it marks beyond them only costs time."""
    return bitmap(values.select(high_bits(values.columns[0]).alias("at")), MARK_BITS)


def high_bits(column: str) -> Column:
    return F.shiftrightunsigned(F.xxhash64(column), 64 - MARK_BITS)


def members_of(reps: DataFrame) -> DataFrame:
    """Points in regions with more than one point: region, rep, n, place. Other regions never leave their task."""
    named = reps.select("rep", "n", F.transform("pivots", lambda p: F.shiftrightunsigned(F.xxhash64(p), 64 - MARK_BITS)).alias("at"), "pivots")
    shared = named.select(F.explode("pivots").alias("region")).groupBy("region").agg(
        F.count(F.lit(1)).alias("points")).where("points > 1").select("region")
    held = named.sparkSession.sparkContext.broadcast(marks(shared))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            lists, places = batch.column("pivots"), batch.column("at")
            offsets = np.asarray(lists.offsets)
            rows = np.repeat(np.arange(batch.num_rows), np.diff(offsets))
            flat, at = (x.flatten().to_numpy(zero_copy_only=False) for x in (lists, places))
            keep = np.flatnonzero(marked(held.value, at))
            row = pa.array(rows[keep])
            yield pa.RecordBatch.from_arrays(
                [pa.array(flat[keep]), batch.column("rep").take(row), batch.column("n").take(row),
                 pa.array((keep - (offsets[:-1] - offsets[0])[rows[keep]]).astype(np.int32))],
                names=["region", "rep", "n", "place"])

    return named.mapInArrow(run, "region long, rep long, n long, place int")


def band_of(size: Column) -> Column:
    return F.floor(F.log(size.cast("double")) / F.lit(np.log(BAND)) + 1e-9).cast("int")


def regions(reps: DataFrame, percent: int) -> DataFrame:
    """Members of all banded regions with more than one point: region, band, rep, n, place, center, points (their number)."""
    # A point is replicated into the following bands as far as the largest set linked to it can lie there.
    bands = F.sequence(band_of(F.col("n")), band_of(F.col("n") * 100 / percent + 1))
    banded = stored(members_of(reps).withColumn("band", F.explode(bands)), "join-regions")
    center = banded.groupBy("region", "band").agg(
        F.min(F.struct("place", "rep", "n")).alias("center"), F.count(F.lit(1)).alias("points")).where("points > 1")
    return stored(banded.join(center, ["region", "band"]), "join-bands")


def may_link(n_a: Column, place_a: Column, n_b: Column, place_b: Column, percent: int) -> Column:
    """Whether sizes and what can still follow the shared pivot leave enough overlap."""
    need = least_overlap(n_a, n_b, percent)
    return (need <= F.least(n_a, n_b)) & (F.least(n_a - place_a, n_b - place_b) >= need)


def may_meet(percent: int) -> Column:
    """Whether two points of a region, the other one's columns ending in 2, are worth comparing.

    The band of the larger one decides, so that a pair which shares two bands meets once a region. Linked sets
    differ in at most n + n2 less twice their overlap, and each shingle held by one alone turns one parity.
    """
    n, n2 = F.col("n"), F.col("n2")
    own = band_of(F.greatest(n, n2)) == F.col("band")
    turned = sum((F.bit_count(F.col(p).bitwiseXOR(F.col(p + "2"))) for p in PARITIES), F.lit(0))
    return (may_link(n, F.col("place"), n2, F.col("place2"), percent) & own & (F.col("rep") != F.col("rep2"))
            & (turned <= n + n2 - 2 * least_overlap(n, n2, percent)))


def pairs_of(one: Column, other: Column) -> list[Column]:
    return [F.least(one, other).alias("a"), F.greatest(one, other).alias("b")]


def alike(pairs: DataFrame, reps: DataFrame, percent: int) -> DataFrame:
    """Pairs whose counts by class differ by no more than linked sets may."""
    shapes = reps.select("rep", "n", "shape")
    both = (pairs.join(shapes.toDF("a", "n_a", "shape_a"), "a").join(shapes.toDF("b", "n_b", "shape_b"), "b"))
    apart = F.aggregate(F.zip_with("shape_a", "shape_b", lambda x, y: F.abs(x - y)), F.lit(0), lambda total, x: total + x)
    most = F.col("n_a") + F.col("n_b") - 2 * least_overlap(F.col("n_a"), F.col("n_b"), percent)
    return both.where(apart <= most).select("a", "b").distinct()


def verified(pairs: DataFrame, sets: DataFrame, percent: int) -> DataFrame:
    """Pairs (a, b) with their Jaccard similarity and whether it is enough, from the full sets."""
    left = sets.select(F.col("doc_id").alias("a"), F.col("held").alias("held_a"))
    right = sets.select(F.col("doc_id").alias("b"), F.col("held").alias("held_b"))
    both = F.size(F.array_intersect("held_a", "held_b"))
    either = F.size("held_a") + F.size("held_b") - F.col("both")
    return (pairs.join(left, "a").join(right, "b").withColumn("both", both)
            .select("a", "b", (F.col("both") / either).alias("similar"), (100 * F.col("both") >= percent * either).alias("linked")))


def links(narrow: DataFrame, reps: DataFrame, size: int, percent: int) -> DataFrame:
    """Links between points that suffice for their components: (a, b)."""
    found = regions(reps, percent)
    is_center = F.col("rep") == F.col("center.rep")
    near = may_link(F.col("n"), F.col("place"), F.col("center.n"), F.col("center.place"), percent)
    members = found.where(~is_center).withColumn("reaches", near)
    star = members.where("reaches").select(*pairs_of(F.col("rep"), F.col("center.rep"))).distinct()
    star = stored(star, "join-star")
    # Only a region with two points besides its pivot has more to compare.
    crowded = members.where("points > 2").select(
        "region", "band", "rep", "n", "place", "reaches", F.col("center.rep").alias("center"))
    crowded = stored(crowded.join(reps.select("rep", "n", *PARITIES).distinct(), ["rep", "n"]), "join-crowded")
    # Points that can't be linked to their region's pivot are compared with whatever else can be linked to them.
    own = ["rep", "n", "place", *PARITIES]
    apart = crowded.where("NOT reaches").select("region", "band", *own)
    others = crowded.select("region", "band", *[F.col(c).alias(c + "2") for c in own], "reaches")
    meet = may_meet(percent)
    loose = apart.join(others, ["region", "band"]).where(meet & (F.col("reaches") | (F.col("rep") < F.col("rep2"))))
    loose = stored(loose.select(*pairs_of(F.col("rep"), F.col("rep2"))).distinct().join(star, ["a", "b"], "left_anti"),
                   "join-loose")
    near_pairs = stored(alike(star.unionByName(loose), reps, percent), "join-alike")
    sets = stored(_sets(narrow, near_pairs, size), "join-sets")
    first = stored(verified(near_pairs, sets, percent), "join-verified")
    # Within reach of the pivot: linked points are connected through it, the others recur with a window.
    seen = crowded.where("reaches").select("region", "band", *own, *pairs_of(F.col("rep"), F.col("center")))
    # Pairs that fell to the class counts are as far apart as any: their similarity stays unknown.
    seen = seen.join(first, ["a", "b"], "left").select("region", "band", *own, "similar",
                                                      F.coalesce("linked", F.lit(False)).alias("linked"))
    far = seen.where("NOT linked").drop("linked")
    rest = seen.select("region", "band", *[F.col(c).alias(c + "2") for c in [*own, "similar"]], "linked")
    window = F.coalesce(F.abs(F.col("similar") - F.col("similar2")) <= F.lit(1 - percent / 100 + 1e-9), F.lit(True))
    again = far.join(rest, ["region", "band"]).where(
        meet & window & (F.col("linked") | (F.col("rep") < F.col("rep2"))))
    again = again.select(*pairs_of(F.col("rep"), F.col("rep2"))).distinct().join(near_pairs, ["a", "b"], "left_anti")
    again = stored(alike(stored(again, "join-again"), reps, percent), "join-again-alike")
    second = verified(again, stored(_sets(narrow, again, size), "join-again-sets"), percent)
    return stored(first.unionByName(second).where("linked").select("a", "b"), "join-links")


def _sets(narrow: DataFrame, pairs: DataFrame, size: int) -> DataFrame:
    """Shingle sets of the points in some pair (and of a few others), from the texts.

    The points are marked in a bitmap of fixed size, so that no text is shuffled. An identifier that
    repeats has a row for each of its texts: its links are those of any of them.
    """
    shared = narrow.sparkSession.sparkContext.broadcast(marks(pairs.select(F.explode(F.array("a", "b")))))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            chosen = marked(shared.value, batch.column("at").to_numpy())
            for part in sliced([batch.filter(pa.array(chosen))], "text", SLICE):
                _, sets = shingle_sets(part, size)
                yield pa.RecordBatch.from_arrays(
                    [part.column("doc_id"), ragged([s.view(np.int64) for s in sets], pa.int64())], names=["doc_id", "held"])

    known = narrow.where(F.col("doc_id").isNotNull()).select("doc_id", "text", high_bits("doc_id").alias("at"))
    return known.mapInArrow(run, "doc_id long, held array<long>")


def components(edges: DataFrame) -> DataFrame:
    """(node, component): smallest node reachable, for all nodes of the edges.

    Large-star and small-star steps by turns, each written to the shared folder, until the edges
    are stars around their smallest nodes.
    """
    current = stored(edges.select(F.least("a", "b").alias("low"), F.greatest("a", "b").alias("high"))
                     .where("low < high").distinct(), "components")
    while True:
        both = current.unionByName(current.select(F.col("high").alias("low"), F.col("low").alias("high")))
        least = both.groupBy(F.col("low").alias("node")).agg(F.least(F.min("high"), F.col("node")).alias("least"))
        large = both.where("high > low").join(least, F.col("low") == F.col("node")).where("high != least")
        large = large.select(F.col("least").alias("low"), "high").distinct()
        parents = large.groupBy(F.col("high").alias("node")).agg(F.min("low").alias("least"))
        small = large.join(parents, F.col("high") == F.col("node")).select("least", "low", "high")
        small = small.select(F.col("least").alias("low"), F.explode(F.array("low", "high")).alias("high")).where("low < high")
        following = stored(small.distinct(), "components")
        same = following.agg(F.count(F.lit(1)).alias("n"), F.bit_xor(F.xxhash64("low", "high")).alias("x")).first()
        before = current.agg(F.count(F.lit(1)).alias("n"), F.bit_xor(F.xxhash64("low", "high")).alias("x")).first()
        current = following
        if same == before:
            break
    nodes = current.select(F.col("high").alias("node"), F.col("low").alias("component"))
    return nodes.unionByName(current.select(F.col("low").alias("node"), F.col("low").alias("component")).distinct())


def _rows_of(sets: DataFrame, reps: DataFrame) -> DataFrame:
    """The points of the representatives (and of a few others), without a shuffle of their pivots."""
    held = sets.sparkSession.sparkContext.broadcast(marks(reps.select("rep")))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            chosen = marked(held.value, batch.column("at").to_numpy())
            yield batch.drop_columns(["at"]).filter(pa.array(chosen))

    named = sets.select(F.col("doc_id").alias("rep"), "n", "pivots", "shape", *PARITIES, high_bits("doc_id").alias("at"))
    return named.mapInArrow(run, f"rep long, n long, pivots array<long>, shape array<smallint>, {PARITY_SCHEMA}")


def jaccard_components(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", size: int = 3,
                       percent: int = 90) -> DataFrame:
    """Per row: doc_id, n_shingles, component_id (smallest identifier reachable by links).

    Null texts and texts without words have no shingles and are linked with nothing. Rows with a
    null identifier keep a null component. Rows that repeat an identifier count as one document: what
    is linked to one is linked to all. An empty table gives no rows; other columns are not read.
    """
    narrow = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).alias("text"))
    small_batches(docs.sparkSession)
    known = stored(points(narrow, shingle_counts(narrow, size), size, percent), "join-points")
    key = ["key_a", "key_b", "n"]
    sets = known.where((F.col("n") > 0) & F.col("doc_id").isNotNull())
    reps = stored(sets.groupBy(*key).agg(F.min("doc_id").alias("rep")), "join-reps")
    found = links(narrow, _rows_of(sets, reps), size, percent)
    # A repeated identifier ties its sets together, too.
    repeated = sets.groupBy("doc_id").agg(F.count_distinct("key_a", "key_b", "n").alias("sets")).where("sets > 1")
    ties = sets.join(repeated.select("doc_id"), "doc_id").join(reps.select(*key, "rep"), key).select(
        F.least("doc_id", "rep").alias("a"), F.greatest("doc_id", "rep").alias("b"))
    labelled = components(found.unionByName(ties))
    classes = reps.select(*key, "rep").join(labelled, F.col("rep") == F.col("node"), "left").select(
        *key, F.coalesce("component", "rep").alias("component"))
    full = known.where("n > 0").select("doc_id", *key).join(classes, key, "left").select(
        "doc_id", F.col("n").alias("n_shingles"), F.when(F.col("doc_id").isNotNull(), F.col("component")).alias("component_id"))
    empty = known.where("n = 0").select("doc_id", F.col("n").alias("n_shingles"), F.col("doc_id").alias("component_id"))
    return full.unionByName(empty)


def numbered(docs: DataFrame, name: str) -> DataFrame:
    """A file-backed frame with a long that names each row for good: number of its file, then index in the file."""
    paths = docs.select(F.col("_metadata.file_path").alias("__path")).distinct()
    # One row a file; neither collected nor broadcast beyond Spark's own size check.
    files = stored(paths.select("__path", (F.row_number().over(Window.orderBy("__path")) - 1).cast("long").alias("__file")), "join-files")
    placed = docs.withColumns({"__path": F.col("_metadata.file_path"), "__index": F.col("_metadata.row_index")})
    number = F.shiftleft("__file", 40).bitwiseOR(F.col("__index")).alias(name)
    return placed.join(files, "__path").select(*docs.columns, number)


def kept_rows(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", size: int = 3, percent: int = 90) -> DataFrame:
    """The rows of a file-backed frame that stay, with all their columns: one of each group of linked texts.

    Rows are documents of their own, whatever their identifiers: only texts link them. The row with the
    smallest identifier stays (null last), then the first by file and place. Rows without words all stay.
    """
    rows = numbered(docs, "__row")
    found = stored(jaccard_components(rows, "__row", text_col, size, percent).where("n_shingles > 0")
                   .select(F.col("doc_id").alias("__row"), "component_id"), "join-result")
    order = F.struct(F.col(id_col).isNull().alias("unnamed"), F.col(id_col).alias("named"), F.col("__row").alias("row"))
    first = found.join(rows.select("__row", order.alias("order")), "__row").groupBy("component_id").agg(
        F.min("order").alias("order")).select(F.col("order.row").alias("__row"))
    leaving = stored(found.select("__row").join(first, "__row", "left_anti"), "join-leaving")
    return rows.join(leaving, "__row", "left_anti").select(*docs.columns)


def jaccard_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document's set size and component under links of at least 0.9."""
    return jaccard_components(read_parquet(spark, f"{sf_dir}/documents.parquet"))


JACCARD_JOIN_SQL = r"""
WITH RECURSIVE d AS (
  SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
         '[^\x20\x09-\x0D]+') AS words FROM documents
), s AS (
  SELECT DISTINCT doc_id, array_to_string(words[i:i + 2], ' ') AS shingle
  FROM (SELECT doc_id, words, unnest(range(1, greatest(len(words) - 2, least(len(words), 1)) + 1)) AS i FROM d)
), n AS (
  SELECT doc_id, count(*) AS n_shingles FROM s GROUP BY doc_id
), links AS (
  SELECT a.doc_id AS a, b.doc_id AS b FROM s a JOIN s b USING (shingle) JOIN n x ON x.doc_id = a.doc_id JOIN n y ON y.doc_id = b.doc_id
  WHERE a.doc_id <> b.doc_id AND 10 * x.n_shingles >= 9 * y.n_shingles AND 10 * y.n_shingles >= 9 * x.n_shingles
  GROUP BY a.doc_id, b.doc_id, x.n_shingles, y.n_shingles
  HAVING 100 * count(*) >= 90 * (x.n_shingles + y.n_shingles - count(*))
), reach AS (
  SELECT a AS node, a AS other FROM links
  UNION
  SELECT node, b AS other FROM reach JOIN links ON a = other
)
SELECT doc_id, coalesce(n_shingles, 0) AS n_shingles, coalesce(least, doc_id) AS component_id
FROM d LEFT JOIN n USING (doc_id) LEFT JOIN (SELECT node AS doc_id, min(other) AS least FROM reach GROUP BY node) USING (doc_id)
"""
