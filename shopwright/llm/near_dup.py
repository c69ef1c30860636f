"""Near-duplicate documents: fast similarity sketches, banding, exact verification.

A document's set holds its distinct word shingles. Equal sets form one class,
found by a digest, and everything after works on classes. A sketch has ``size``
coordinates, filled in rounds: in round i every shingle goes to the coordinate
that a hash for i names, and from round ``size`` on to coordinate i - size, so
that after 2 * size rounds at the latest each coordinate has a value. Smaller
(round, hash) pairs win; two sets agree in a coordinate with the probability of
their Jaccard similarity. Bands of ``rows`` coordinates are bucket keys.

Links in a bucket are looked for in two steps. First each class is compared with
the bucket's hub, the class that shares most buckets with others, and linked classes
join into components. Then classes that met one hub and are still in different
components are compared if they can be linked at all: as one of them is not
linked to the hub, they must differ from the hub in the same elements, of which
there are few (see ``_compared``). They are compared in rounds with one of each list of candidates, and what
is then still apart in full (``_late_links``). So a group of copies costs about as many comparisons
as it has members, and no candidate is left out. Every link is confirmed on the full sets.

With 80 bands of 8 rows a pair of similarity 0.8 shares no bucket with
probability (1 - 0.8^8)^80 = 4e-7, and one of similarity 0.2 shares one with 2e-4.

Defined cases: a null or wordless text has an empty set and is alone. Fewer words
than a shingle needs make one shingle of all words. Rows with the same id and
text are each reported. Null ids: such a row takes part in links, but does not
give its component a name unless no member has an id. Columns other than id and
text are ignored. An empty table gives no rows.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from shopwright.llm import grams
from shopwright.shared import stored

BANDS, ROWS = 80, 8
# Candidate pairs for each place in the lists, up to which all are compared at once.
FEW_PAIRS = 2
_PLACE, _VALUE = 0xA24BAED4963EE407, np.uint64(0x9FB21C651E98DF25)


def shingle_sets(words: grams.Words, shingle: int) -> tuple[np.ndarray, np.ndarray]:
    """Sorted distinct shingle hashes of all texts in a row, and where each text's begin."""
    count = np.diff(words.first)
    text = np.repeat(np.arange(len(count)), count)
    whole = grams.grams(words.hashes, shingle)
    # The last shingle - 1 places of a text have no full window.
    ok = np.arange(len(whole)) + shingle <= words.first[1:][text[: len(whole)]]
    values, owner = whole[ok], text[: len(whole)][ok]
    short = np.flatnonzero((count > 0) & (count < shingle))
    if len(short):
        made = [grams.grams(words.hashes[words.first[i] : words.first[i + 1]], int(count[i]))[0] for i in short]
        values, owner = np.append(values, np.array(made, np.uint64)), np.append(owner, short)
    order = np.lexsort((values, owner))
    values, owner = values[order], owner[order]
    new = np.ones(len(values), bool)
    new[1:] = (values[1:] != values[:-1]) | (owner[1:] != owner[:-1])
    values, owner = values[new], owner[new]
    return values, np.searchsorted(owner, np.arange(len(count) + 1))


def sketches(values: np.ndarray, first: np.ndarray, size: int) -> np.ndarray:
    """Fast similarity sketch of each set; all ones for an empty set."""
    n = len(first) - 1
    out = np.full(n * size, ~np.uint64(0))
    length = np.diff(first)
    owner = np.repeat(np.arange(n), length)
    live = values
    for turn in range(2 * size):
        if not len(live):
            break
        hashed = grams.mixed(live + np.uint64((turn + 1) * _PLACE % (1 << 64)))
        if turn < size:
            place = owner * size + ((hashed >> np.uint64(32)) % np.uint64(size)).astype(np.int64)
        else:
            place = owner * size + (turn - size)
        value = (np.uint64(turn) << np.uint64(52)) | (grams.mixed(hashed + _VALUE) >> np.uint64(12))
        np.minimum.at(out, place, value)
        # Sets whose coordinates are all filled take no further part.
        open_sets = (out.reshape(n, size) == ~np.uint64(0)).any(axis=1)
        keep = open_sets[owner]
        if not keep.all():
            live, owner = live[keep], owner[keep]
    return out.reshape(n, size)


def _digests(values: np.ndarray, first: np.ndarray) -> np.ndarray:
    """Two sums over each set's hashes: the same for equal sets only."""
    out = np.zeros((len(first) - 1, 2), np.uint64)
    full = np.flatnonzero(np.diff(first))
    if len(full):
        for k, salt in enumerate((0x2545F4914F6CDD1D, 0x8CB92BA72F3D8DD7)):
            out[full, k] = np.add.reduceat(grams.mixed(values ^ np.uint64(salt)), first[full])
    return out


def _band_keys(sketch: np.ndarray, bands: int, rows: int) -> np.ndarray:
    keys = np.full((len(sketch), bands), 1, np.uint64) * np.arange(1, bands + 1, dtype=np.uint64)
    for r in range(rows):
        keys = keys * np.uint64(0xD6E8FEB86659FD93) + sketch[:, r::rows]
    return grams.mixed(keys)


def signatures(docs: DataFrame, shingle: int, bands: int = BANDS, rows: int = ROWS) -> DataFrame:
    """doc_id, node (names the set's class), n_shingles, keys (one per band; none for an empty set)."""

    def made(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for lo, hi, data, offsets in grams.slices(batch.column(1)):
                words = grams.words(data, offsets, grams.SPACE_WORD)
                values, first = shingle_sets(words, shingle)
                digest = _digests(values, first)
                node = np.ascontiguousarray(digest).view("S16").ravel()
                full = np.diff(first) > 0
                keys = _band_keys(sketches(values, first, bands * rows), bands, rows)[full].view(np.int64).ravel()
                yield pa.record_batch(
                    [
                        batch.column(0).slice(lo, hi - lo),
                        pa.array([digest[i].tobytes() for i in range(len(node))], pa.binary()),
                        pa.array(np.diff(first)),
                        pa.ListArray.from_arrays(
                            pa.array(np.append(0, np.cumsum(full * bands)).astype(np.int32)), pa.array(keys)
                        ),
                    ],
                    names=["doc_id", "node", "n_shingles", "keys"],
                )
        grams.give_back()

    doc_id = docs.schema["doc_id"].dataType.simpleString()
    return docs.select("doc_id", "text").mapInArrow(
        made, f"doc_id {doc_id}, node binary, n_shingles long, keys array<long>"
    )


def shingle_tables(docs: DataFrame, shingle: int) -> DataFrame:
    """doc_id, node, hashes (the sorted distinct shingle hashes)."""

    def made(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for lo, hi, data, offsets in grams.slices(batch.column(1)):
                values, first = shingle_sets(grams.words(data, offsets, grams.SPACE_WORD), shingle)
                digest = _digests(values, first)
                yield pa.record_batch(
                    [
                        batch.column(0).slice(lo, hi - lo),
                        pa.array([d.tobytes() for d in digest], pa.binary()),
                        pa.ListArray.from_arrays(pa.array(first.astype(np.int32)), pa.array(values.view(np.int64))),
                    ],
                    names=["doc_id", "node", "hashes"],
                )
        grams.give_back()

    doc_id = docs.schema["doc_id"].dataType.simpleString()
    return docs.select("doc_id", "text").mapInArrow(made, f"doc_id {doc_id}, node binary, hashes array<long>")


def _compared(pairs: DataFrame, sets: DataFrame, percent: int) -> DataFrame:
    """a, b, need, own and diff for pairs (a, b), from their full sets.

    diff is what only one of the two sets has. The two are linked when ``need`` is 0 or
    less; else it says how many elements of its diff a must share with the diff of a third
    set linked to it. Any set linked to another one that is not linked to b shares more than
    ``own`` elements of its diff with it.

    Why: let u and m be sets, h the set b, and a pair linked when it shares at least
    p / (100 + p) of the sum of both sizes. u and m share |h| - missing(u) - missing(m) + o
    elements, o being the size of the intersection of their diffs. So they are linked when o >= need(u) + c(m),
    with c(m) = (100 * missing(m) + p * extra(m)) / (100 + p) and need(u) what u lacks to be linked to h.
    """
    whole = 100 + percent
    more, less = F.array_except("left", "right"), F.array_except("right", "left")
    extra, missing = F.size("more"), F.size("less")
    # What the two share, from one side's size and what it has alone.
    shared = F.size("left") - extra
    lacking = F.lit(percent) * (F.size("left") + F.size("right")) - F.lit(whole) * shared
    return (
        pairs.join(sets.select(F.col("node").alias("a"), F.col("hashes").alias("left")), "a")
        .join(sets.select(F.col("node").alias("b"), F.col("hashes").alias("right")), "b")
        .select("a", "b", "left", "right", more.alias("more"), less.alias("less"))
        .select(
            "a",
            "b",
            F.ceil(lacking / whole).alias("need"),
            F.floor((100 * missing + percent * extra) / whole).alias("own"),
            F.concat("more", "less").alias("diff"),
        )
    )


def _linked(pairs: DataFrame, sets: DataFrame, percent: int) -> DataFrame:
    """Those of the pairs (a, b) that are linked."""
    shared = F.size(F.array_intersect("left", "right"))
    return (
        pairs.join(sets.select(F.col("node").alias("a"), F.col("hashes").alias("left")), "a")
        .join(sets.select(F.col("node").alias("b"), F.col("hashes").alias("right")), "b")
        .filter(F.lit(100 + percent) * shared >= F.lit(percent) * (F.size("left") + F.size("right")))
        .select("a", "b")
    )


def _postings(compared: DataFrame, labels: DataFrame, percent: int) -> DataFrame:
    """b, element, node, seeks, offers: which classes of different components, compared with one hub b, may be linked.

    One of two such classes is in another component than the hub, hence not linked to it. The
    elements of each diff are ordered by how few classes of the hub have them; two diffs that
    share k elements share one among the first |diff| - k + 1 of each. So a class that seeks
    a link under an element can only be linked to those that offer themselves under one of its elements.
    """
    comps = labels.select("node", "comp")
    rows = (
        compared.withColumnRenamed("a", "node")
        .join(comps, "node", "left")
        .withColumn("comp", F.coalesce("comp", "node"))
        .join(comps.select(F.col("node").alias("b"), F.col("comp").alias("hub_comp")), "b", "left")
        .withColumn("outside", F.col("comp") != F.coalesce("hub_comp", "b"))
        .select("b", "node", "outside", "need", "own", "diff")
    )
    rows = stored(rows, "rows")
    open_hubs = rows.filter("outside").select("b").distinct()
    elements = stored(
        rows.join(open_hubs, "b", "left_semi").select(
            "b", "node", "outside", "need", "own", F.size("diff").alias("size"), F.explode("diff").alias("element")
        ),
        "elements",
    )
    often = stored(elements.groupBy("b", "element").agg(F.count("*").alias("times")), "often")
    order = Window.partitionBy("b", "node").orderBy("times", "element")
    ranked = elements.join(often.filter("times > 1"), ["b", "element"]).withColumn(
        # Elements that no other class of the hub has come first and can't be shared.
        "place", F.row_number().over(order) + F.col("size") - F.count("*").over(Window.partitionBy("b", "node"))
    )
    seeks = F.col("outside") & (F.col("place") <= F.col("size") - F.col("need") + 1)
    offers = F.col("place") <= F.col("size") - F.col("own")
    return ranked.select("b", "element", "node", seeks.alias("seeks"), offers.alias("offers")).filter("seeks or offers")


def _open_postings(postings: DataFrame, labels: DataFrame) -> DataFrame:
    """The postings, with comp, of those elements under which a class still seeks one of another component."""
    comps = labels.select("node", "comp")
    rows = stored(
        postings.join(comps, "node", "left").withColumn("comp", F.coalesce("comp", "node")), "postings"
    )
    open_ones = (
        rows.groupBy("b", "element")
        .agg(F.bool_or("seeks").alias("sought"), F.min("comp").alias("low"), F.max("comp").alias("high"))
        .filter("sought and low < high")
    )
    return stored(rows.join(open_ones.select("b", "element"), ["b", "element"], "left_semi"), "open")


def _candidates(rows: DataFrame, sizes: DataFrame, percent: int, star: int | None) -> DataFrame:
    """Pairs of rows under one element that seek and offer a link, all of them or (star) with one
    chosen class of each element, another one in each round."""
    rows = rows.join(sizes, "node")
    right = rows.filter("offers").select(
        "b", "element", F.col("node").alias("m"), F.col("n").alias("n_m"), F.col("comp").alias("comp_m")
    )
    if star is None:
        left = rows.filter("seeks").select(
            "b", "element", F.col("node").alias("u"), F.col("n").alias("n_u"), F.col("comp").alias("comp_u")
        )
    else:
        chosen = F.max(F.struct(F.xxhash64("node", F.lit(star)), F.struct("node", "n", "comp").alias("who"))).alias("best")
        left = rows.groupBy("b", "element").agg(chosen).select(
            "b", "element", F.col("best.who.node").alias("u"), F.col("best.who.n").alias("n_u"), F.col("best.who.comp").alias("comp_u")
        )
        right = rows.select(
            "b", "element", F.col("node").alias("m"), F.col("n").alias("n_m"), F.col("comp").alias("comp_m")
        )
    return (
        left.join(right, ["b", "element"])
        .filter((F.col("comp_u") != F.col("comp_m")) & _near_size("n_u", "n_m", percent))
        .select(F.least("u", "m").alias("a"), F.greatest("u", "m").alias("b"))
        .distinct()
    )


def _all_pairs(rows: DataFrame) -> int:
    """How many places in lists of pairs would be of different components."""
    parts = rows.groupBy("b", "element", "comp").agg(
        F.sum(F.col("seeks").cast("long")).alias("s"), F.sum(F.col("offers").cast("long")).alias("o")
    )
    sums = parts.groupBy("b", "element").agg((F.sum("s") * F.sum("o") - F.sum(F.col("s") * F.col("o"))).alias("pairs"))
    return sums.agg(F.sum("pairs").alias("pairs")).first()["pairs"] or 0


def _late_links(
    compared: DataFrame, sets: DataFrame, sizes: DataFrame, edges: DataFrame, labels: DataFrame, percent: int
) -> DataFrame:
    """Labels after also linking classes that met one hub and were left in different components.

    Rounds compare the classes under each element with one of them, as long as this joins components and
    comparing all that are apart would be many pairs; copies soon become one component.
    """
    postings = stored(_postings(compared, labels, percent), "places")
    rows = _open_postings(postings, labels)
    turn = 0
    while not rows.isEmpty():
        few = _all_pairs(rows) <= FEW_PAIRS * rows.count()
        pairs = stored(_candidates(rows, sizes, percent, None if few else turn), "pairs")
        found = stored(_linked(pairs, sets, percent), "links")
        if found.isEmpty() and not few:
            # Joining has come to an end, so what is left is compared in full.
            found = stored(_linked(_candidates(rows, sizes, percent, None), sets, percent), "links")
            few = True
        edges = edges.unionByName(found)
        labels = components(edges)
        if few:
            break
        rows = _open_postings(postings, labels)
        turn += 1
    return labels


def components(edges: DataFrame) -> DataFrame:
    """node, comp: the smallest node of each connected component, for nodes with an edge.

    Every node points at its smallest neighbour's label and labels follow their own
    pointers, so that chains shrink by more than half a round. Each round is stored.
    """
    both = stored(edges.unionByName(edges.select(F.col("b").alias("a"), F.col("a").alias("b"))), "edges")
    labels = stored(both.groupBy(F.col("a").alias("node")).agg(F.min(F.least("a", "b")).alias("comp")), "labels")
    while True:
        of_b = labels.select(F.col("node").alias("b"), F.col("comp").alias("near"))
        reached = both.join(of_b, "b").groupBy(F.col("a").alias("node")).agg(F.min("near").alias("near"))
        # The label's own label, and the smallest label seen from any node that has this label.
        stepped = stored(
            labels.join(reached, "node").select("node", "comp", F.least("comp", "near").alias("near")), "steps"
        )
        if stepped.filter("near < comp").isEmpty():
            return labels
        root = stepped.groupBy(F.col("comp").alias("label")).agg(F.min("near").alias("root"))
        hop = root.select(F.col("label").alias("root"), F.col("root").alias("next"))
        root = root.join(hop, "root", "left").select("label", F.coalesce("next", "root").alias("root"))
        root = stored(root, "roots")
        labels = stored(
            stepped.join(root, stepped.comp == root.label).select("node", F.least("near", "root").alias("comp")),
            "labels",
        )


def _near_size(a: str, b: str, percent: int) -> F.Column:
    small, large = F.least(a, b), F.greatest(a, b)
    return small * 100 >= large * percent


def near_duplicates(
    docs: DataFrame, shingle: int = 5, percent: int = 80, bands: int = BANDS, rows: int = ROWS
) -> DataFrame:
    """One row per document: doc_id, n_shingles, component_id (the smallest doc_id linked to it,
    directly or through others), kept (it is that document).

    Documents are linked when 100 * shared >= percent * all shingles of the two.
    """
    spark = docs.sparkSession
    with grams.small_batches(spark):
        rows_of = stored(signatures(docs, shingle, bands, rows), "signatures")
    classes = stored(
        rows_of.filter("n_shingles > 0")
        .groupBy("node")
        .agg(
            F.min("doc_id").alias("doc_id"),
            F.first("n_shingles").alias("n"),
            F.first("keys").alias("keys"),
        ),
        "classes",
    )
    buckets = classes.select("node", "n", F.explode("keys").alias("bucket"))
    shared = stored(buckets.groupBy("bucket").agg(F.count("*").alias("members")).filter("members > 1"), "buckets")
    members = stored(buckets.join(shared, "bucket"), "members")

    weight = members.groupBy("node").agg(F.sum("members").alias("weight"))
    weighed = members.join(weight, "node")
    hubs = stored(
        weighed.groupBy("bucket").agg(F.max(F.struct("weight", "node")).alias("hub"))
        .select("bucket", F.col("hub.node").alias("b")),
        "hubs",
    )
    pairs = stored(
        members.join(hubs, "bucket").filter(F.col("node") != F.col("b")).select(F.col("node").alias("a"), "b").distinct(),
        "pairs",
    )

    # Full sets of the classes in some pair, from one document of each.
    wanted = pairs.select(F.explode(F.array("a", "b")).alias("node")).distinct()
    chosen = stored(classes.select("node", "doc_id").join(wanted, "node"), "chosen")
    texts = docs.select("doc_id", "text").join(
        chosen.select(F.col("doc_id").alias("chosen_id")).distinct(),
        F.col("doc_id").eqNullSafe(F.col("chosen_id")),
        "left_semi",
    )
    found = shingle_tables(texts, shingle).join(chosen.select("node"), "node", "left_semi")
    sets = stored(found.dropDuplicates(["node"]).select("node", "hashes"), "sets")

    compared = stored(_compared(pairs, sets, percent), "compared")
    edges = compared.filter("need <= 0").select("a", "b")
    labels = _late_links(compared, sets, classes.select("node", "n"), edges, components(edges), percent)

    named = classes.select("node", "doc_id").join(labels, "node", "left")
    named = named.select("node", "doc_id", F.coalesce("comp", "node").alias("comp"))
    names = named.groupBy("comp").agg(F.min("doc_id").alias("component_id"))
    result = stored(named.join(names, "comp").select("node", "component_id"), "components")
    out = rows_of.select("doc_id", "node", "n_shingles").join(result, "node", "left")
    component = F.when(F.col("n_shingles") == 0, F.col("doc_id")).otherwise(F.col("component_id"))
    return out.select(
        "doc_id", "n_shingles", component.alias("component_id"), F.col("doc_id").eqNullSafe(component).alias("kept")
    )


def drop_near_duplicates(docs: DataFrame, shingle: int = 5, percent: int = 80) -> DataFrame:
    """The documents with one of each group, in the columns they came with.

    Repeated rows of the kept document leave one row.
    """
    found = near_duplicates(docs, shingle, percent).filter("kept").select(F.col("doc_id").alias("kept_id")).distinct()
    kept = docs.join(found, docs["doc_id"].eqNullSafe(found["kept_id"]), "left_semi")
    return kept.dropDuplicates(["doc_id", "text"])
