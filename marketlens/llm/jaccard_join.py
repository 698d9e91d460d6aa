"""N-gram Jaccard join by vertical partitioning: components of documents whose shingle sets are similar enough.

The global order of the shingles is that of their hashes. It is cut into fragments; a document's part of a fragment is a
segment. Everything works on fragments:

* Candidates. Two sets with n and m shingles reach a similarity of p/q only if at most t = (n + m)(q - p)/(q + p) shingles
  are in one of them alone. With t + 3 fragments at least three segments are equal. So documents that share no segment
  are never compared. The number of fragments follows from the size class of the larger set. A set is cut for its own
  class, and for the next one if it can be similar to a set of that. Should all equal segments be empty, both sets have
  three empty ones; only such sets also meet by their empty segments.
* Overlaps. A pair's overlap is counted per fragment, apart from each other, and the counts are summed per pair. A task
  holds two segments of a pair, never two documents.

Pairs are not enumerated within groups. Equal sets are one set from the start. Of the sets that share a segment, the one
that shares most segments with others is the pivot, and all are compared with it; similar ones are linked, and linked
sets form components. Then only pairs of different components can matter. Both sets of such a pair differ from their
common pivot, and by the triangle inequality of the symmetric difference those deltas must have shingles in common: if
they had none, both would be linked to the pivot. Where few sets share a segment, their pairs are told outright. The
pairs that share only segments of many sets are found by a prefix filter on the deltas, rarest shingles first: the
shingles that a whole family of documents shares are in no delta. As such a pair shares three segments, a set needs no
delta to the pivots of its last two in one order of all segments. All pairs found are verified by their exact overlap.
Nothing is capped or left out.

Shingles are runs of ``size`` words, words are runs of bytes other than white space, A-Z lower-cased. A shorter text is
one shingle, a null one or one without words has none and is linked with nothing. Shingles are told apart by 64-bit,
whole sets by 128-bit hashes. A component is named by its smallest key; keys are integers, a null key names nothing.
Rows with equal keys are documents of their own, as are repeated rows. Very long texts are read piece by piece. Extra
columns are not read. An empty table gives an empty result.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import cache

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from marketlens.llm.common import _BYTE_VALUE, in_runs, mixed, slices, staged, table, text_bytes
from marketlens.llm.links import components, delta_pairs, with_pivots
from marketlens.llm.pieces import windows, words_between

SIZE, NUMERATOR, DENOMINATOR = 3, 9, 10
# How many segments of similar sets are equal at least.
EQUAL = 3
# Up to so many documents that share a segment, their keys (some tens of MB) are broadcast to the scan of the texts; beyond, the
# texts are shuffled once. Likewise for the sets of a comparison and the scan of the segments.
BROADCAST_KEYS = 1_000_000
# Of a segment that so many sets or fewer have beside the pivot, all pairs are told; beyond, those of similar deltas.
FEW = 16
# Bytes of a word that are hashed in one step.
STRETCH = 1 << 16
_IN_WORD = np.ones(256, bool)
_IN_WORD[[32, *range(9, 14)]] = False
_BASE = 0x9E3779B97F4A7C15
_STEP = np.uint64(_BASE)
_POWER = np.multiply.accumulate(np.r_[np.uint64(1), np.full(STRETCH - 1, _STEP)])


def hashes_of_words(data: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """A hash of every span's bytes and length, A-Z as a-z."""
    length = ends - starts
    out = np.zeros(len(starts), np.uint64)
    short = np.flatnonzero(length <= STRETCH)
    if len(short):
        at = in_runs(length[short])
        values = _BYTE_VALUE[data[np.repeat(starts[short], length[short]) + at]] * _POWER[at]
        out[short] = np.add.reduceat(values, np.cumsum(length[short]) - length[short])
    for k in np.flatnonzero(length > STRETCH):
        total = 0
        for begin in range(starts[k], ends[k], STRETCH):
            part = _BYTE_VALUE[data[begin : min(begin + STRETCH, ends[k])]]
            total += int((part * _POWER[: len(part)]).sum(dtype=np.uint64)) * pow(_BASE, int(begin - starts[k]), 1 << 64)
        out[k] = total % (1 << 64)
    return mixed(out + mixed(length.astype(np.uint64)))


def shingle_sets(column: pa.Array, size: int) -> tuple[np.ndarray, np.ndarray]:
    """Hash and text number of every distinct shingle of every text, by text and hash."""
    data, offsets = text_bytes(column)
    word, text = [np.empty(0, np.uint64)], [np.empty(0, np.int64)]
    for start, end in windows(data, offsets, _IN_WORD):
        starts, ends, row = words_between(data, offsets, _IN_WORD, start, end)
        word.append(hashes_of_words(data[start:end], starts, ends))
        text.append(row)
    word, text = np.concatenate(word), np.concatenate(text)
    words = np.bincount(text, minlength=len(column))
    last = max(len(word) - size + 1, 0)
    runs = word[:last].copy()
    for k in range(1, size):
        runs = mixed(runs * _STEP + word[k : last + k])
    whole = text[:last] == text[size - 1 :] if last else np.empty(0, bool)
    shingle, owner = [runs[whole]], [text[:last][whole]]
    first = np.cumsum(words) - words
    for n in range(1, size):
        short = np.flatnonzero(words == n)
        h = np.full(len(short), n, np.uint64)
        for k in range(n):
            h = mixed(h * _STEP + word[first[short] + k])
        shingle.append(h)
        owner.append(short)
    shingle, owner = np.concatenate(shingle), np.concatenate(owner)
    order = np.lexsort((shingle, owner))
    shingle, owner = shingle[order], owner[order]
    fresh = np.r_[True, (shingle[1:] != shingle[:-1]) | (owner[1:] != owner[:-1])][: len(shingle)]
    return shingle[fresh], owner[fresh]


@cache
def size_classes(p: int, q: int) -> tuple[np.ndarray, np.ndarray]:
    """The smallest size of every class, and into how many fragments sets are cut for it (0: only equal sets are similar).

    A class reaches at least up to the largest size that can be similar to its smallest one, so similar sets are of one
    class or of neighbouring ones.
    """
    least = [1]
    while least[-1] < 1 << 40:
        least.append(max(least[-1] * q // p, least[-1] * 3 // 2) + 1)
    t = 2 * (np.array(least[1:], np.int64) - 1) * (q - p) // (q + p)
    return np.array(least[:-1], np.int64), np.where(t > 0, t + EQUAL, 0)


def cuts_of(n: np.ndarray, p: int, q: int) -> tuple[np.ndarray, list[np.ndarray]]:
    """The class of every set size, and into how many fragments it is cut for that class and for the next (0: not at all)."""
    least, fragments = size_classes(p, q)
    kind = np.searchsorted(least, n, "right") - 1
    reaches = (n > 0) & (n * q // p >= least[kind + 1])
    return kind, [np.where(n > 0, fragments[kind], 0), np.where(reaches, fragments[kind + 1], 0)]


def fragment_of(shingle: np.ndarray, fragments: np.ndarray) -> np.ndarray:
    return (((shingle >> np.uint64(32)) * fragments.astype(np.uint64)) >> np.uint64(32)).astype(np.int64)


def set_names(shingle: np.ndarray, text: np.ndarray, texts: int) -> np.ndarray:
    """Two 64-bit hashes of each text's set."""
    same = np.zeros((2, texts), np.uint64)
    for k in (0, 1):
        np.add.at(same[k], text, mixed(shingle + np.uint64((k + 1) * _BASE % (1 << 64))))
    return same.view(np.int64)


def segment_names(
    shingle: np.ndarray, text: np.ndarray, cut: np.ndarray, fragments: np.ndarray
) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """A hash of every segment of every text, with class and fragment, and its text number; and how many are empty per text.

    ``cut``: the class that each text is cut for; ``fragments``: into how many.
    """
    there = fragments[text] > 0
    shingle, text = shingle[there], text[there]
    fragment = fragment_of(shingle, fragments[text])
    starts = np.flatnonzero(np.r_[True, (text[1:] != text[:-1]) | (fragment[1:] != fragment[:-1])][: len(text)])
    if not len(starts):
        return np.empty(0, np.uint64), np.empty(0, np.int64), np.zeros(len(cut), np.int64)
    owner, fragment = text[starts], fragment[starts]

    def place(owner: np.ndarray, fragment: np.ndarray) -> np.ndarray:
        return mixed((cut[owner].astype(np.uint64) << np.uint64(40)) + fragment.astype(np.uint64) + np.uint64(1))

    names = [mixed(np.add.reduceat(mixed(shingle ^ _STEP), starts) + place(owner, fragment))]
    owners = [owner]
    empty = np.where(fragments > 0, fragments - np.bincount(owner, minlength=len(cut)), 0)
    for t in np.flatnonzero(empty >= EQUAL):
        bare = np.setdiff1d(np.arange(fragments[t]), fragment[owner == t])
        owners.append(np.full(len(bare), t))
        names.append(mixed(place(owners[-1], bare) ^ _STEP))
    return np.concatenate(names), np.concatenate(owners), empty


def sketches(docs: DataFrame, size: int, p: int, q: int) -> DataFrame:
    """Per row: key, low, high (together the name of its set), n, kind (size class), empty (how many of its segments are, at
    most, in one way of cutting), segments (names)."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches):
            shingle, text = shingle_sets(batch.column("text"), size)
            n = np.bincount(text, minlength=batch.num_rows)
            kind, fragments = cuts_of(n, p, q)
            low, high = set_names(shingle, text, batch.num_rows)
            found = [segment_names(shingle, text, kind + k, fragments[k]) for k in (0, 1)]
            name, owner = (np.concatenate([f[i] for f in found]) for i in (0, 1))
            empty = np.maximum(found[0][2], found[1][2])
            order = np.argsort(owner, kind="stable")
            ends = np.searchsorted(owner[order], np.arange(batch.num_rows + 1))
            lists = pa.ListArray.from_arrays(pa.array(ends, pa.int32()), pa.array(name[order].view(np.int64)))
            yield pa.RecordBatch.from_arrays(
                [batch.column("key"), pa.array(low), pa.array(high), pa.array(n, pa.int64()), pa.array(kind, pa.int32()), pa.array(empty, pa.int32()), lists],
                ["key", "low", "high", "n", "kind", "empty", "segments"],
            )

    return docs.mapInArrow(run, "key long, low long, high long, n long, kind int, empty int, segments array<long>")


def segments(docs: DataFrame, size: int, p: int, q: int) -> DataFrame:
    """id, cut (the class that it is cut for), fragment, items: all segments, empty ones too, of rows id, low, high, text.

    Rows whose text has another set than that of the name low, high are left out: another row has their key.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches):
            shingle, text = shingle_sets(batch.column("text"), size)
            ids, *wanted = (batch.column(c).to_numpy(zero_copy_only=False) for c in ("id", "low", "high"))
            right = (set_names(shingle, text, batch.num_rows) == np.stack(wanted)).all(axis=0)
            n = np.bincount(text, minlength=batch.num_rows)
            kind, fragments = cuts_of(n, p, q)
            for k in (0, 1):
                pieces = np.where(right, fragments[k], 0)
                owner, fragment = np.repeat(np.arange(len(n)), pieces), in_runs(pieces)
                there = pieces[text] > 0
                place = (np.cumsum(pieces) - pieces)[text] + fragment_of(shingle, pieces[text])
                ends = np.searchsorted(place[there], np.arange(len(owner) + 1))
                items = pa.ListArray.from_arrays(pa.array(ends, pa.int32()), pa.array(shingle[there].view(np.int64)))
                columns = [ids[owner], (kind + k)[owner].astype(np.int32), fragment.astype(np.int32)]
                yield pa.RecordBatch.from_arrays([*map(pa.array, columns), items], ["id", "cut", "fragment", "items"])

    return docs.mapInArrow(run, "id long, cut int, fragment int, items array<long>")


def ends_of(pairs: DataFrame, end: str, cut: DataFrame) -> DataFrame:
    """The segments of the sets at one end of the pairs, so that no others are shuffled; all, where the sets are too many to tell."""
    ids = pairs.select(F.col(end).alias("id")).distinct()
    return cut.join(F.broadcast(ids), "id", "left_semi") if ids.count() <= BROADCAST_KEYS else cut


def differences(pairs: DataFrame, cut: DataFrame) -> DataFrame:
    """Pairs a, b, cut: per pair and fragment a, b, part (how many shingles both have), items (those that one has alone)."""
    a = ends_of(pairs, "a", cut).withColumnsRenamed({"id": "a", "items": "of_a"})
    b = ends_of(pairs, "b", cut).withColumnsRenamed({"id": "b", "items": "of_b"})
    met = pairs.select("a", "b", "cut").join(a, ["a", "cut"]).join(b, ["b", "cut", "fragment"])
    alone = F.concat(F.array_except("of_a", "of_b"), F.array_except("of_b", "of_a"))
    items = F.when(F.col("of_a") != F.col("of_b"), alone).otherwise(F.array().cast("array<long>"))
    rows = met.select("a", "b", F.size("of_a").alias("s"), F.size("of_b").alias("t"), items.alias("items"))
    return rows.select("a", "b", ((F.col("s") + F.col("t") - F.size("items")) / 2).cast("int").alias("part"), "items")


def similar(overlap: Column, n: Column, m: Column, p: int, q: int) -> Column:
    return q * overlap >= p * (n + m - overlap)


def sized_pairs(pairs: DataFrame, sharing: DataFrame, p: int, q: int) -> DataFrame:
    """Pairs a, b with n and m (sizes), cut, likely: whether as many segments are equal as in similar sets of any size; and
    close: whether their sizes allow similarity and all fragments are equal but one for each shingle that one may have alone.

    ``sharing``: id, n, kind, empty, segments (those that others have too) of the sets that share any.
    """
    a = sharing.select(F.col("id").alias("a"), "n", F.col("kind").alias("i"), F.col("empty").alias("e"), F.col("segments").alias("of_a"))
    b = sharing.select(F.col("id").alias("b"), F.col("n").alias("m"), F.col("kind").alias("j"), F.col("empty").alias("f"), F.col("segments").alias("of_b"))
    equal = F.size(F.array_intersect("of_a", "of_b")) + F.least("e", "f")
    fragments = F.get(F.array(*[F.lit(f) for f in size_classes(p, q)[1].tolist()]), F.col("cut"))
    apart = F.floor((F.col("n") + F.col("m")) * (q - p) / (q + p))
    close = (equal >= fragments - apart) & (q * F.least("n", "m") >= p * F.greatest("n", "m"))
    rows = pairs.join(a, "a").join(b, "b").withColumn("cut", F.greatest("i", "j"))
    return staged(rows.select("a", "b", "n", "m", "cut", (equal >= EQUAL).alias("likely"), close.alias("close")), "pairs")


def compared(sized: DataFrame, cut: DataFrame, p: int, q: int) -> tuple[DataFrame, DataFrame]:
    """Of pairs a, b, n, m, cut: a, b, n, m, overlap, similar; and their differences by fragment."""
    parts = staged(differences(sized, cut), "differences")
    overlap = parts.groupBy("a", "b").agg(F.sum("part").alias("overlap"))
    counted = sized.select("a", "b", "n", "m").join(overlap, ["a", "b"])
    return staged(counted.withColumn("similar", similar(F.col("overlap"), F.col("n"), F.col("m"), p, q)), "overlaps"), parts


def of_several_roots(rows: DataFrame) -> DataFrame:
    """Rows segment, root, ..: those of segments that sets of several roots have, with holders (how many have it)."""
    found = rows.groupBy("segment").agg((F.min("root") != F.max("root")).alias("mixed"), F.count("*").alias("holders"))
    return rows.join(found.filter("mixed").drop("mixed"), "segment")


def pairs_of_few(rows: DataFrame) -> DataFrame:
    """Pairs a < b of different roots that share a segment, of rows segment, id, root with few to a segment."""
    a = rows.select("segment", F.col("id").alias("a"), F.col("root").alias("s"))
    b = rows.select("segment", F.col("id").alias("b"), F.col("root").alias("t"))
    return a.join(b, "segment").filter("a < b AND s != t").select("a", "b").distinct()


def around_pivots(rows: DataFrame) -> DataFrame:
    """a (a set), b (a pivot), root: by which pairs that share ``EQUAL`` segments of the rows (segment, id, pivot, root, empty)
    have a pivot in common. Empty segments count for the set, as they may have no names."""
    for _ in range(2):
        enough = rows.groupBy("id").agg((F.count("*") + F.first("empty") >= EQUAL).alias("enough")).filter("enough").select("id")
        rows = of_several_roots(rows.join(enough, "id")).drop("holders")
    rows = staged(rows, "crowded")
    # In one order of all segments, the first that two sets share is among the last EQUAL - 1 of neither. Those of large
    # families come first, so that a set keeps few pivots.
    weights = rows.groupBy("pivot").agg(F.count("*").alias("weight"))
    order = F.sort_array(F.collect_list(F.struct("weight", "pivot", "segment")), asc=False).alias("order")
    ordered = rows.join(weights, "pivot").groupBy("id", "root").agg(order, F.first("empty").alias("empty"))
    kept = F.slice("order", F.lit(1), F.greatest(F.size("order") - F.greatest(EQUAL - 1 - F.col("empty"), F.lit(0)), F.lit(0)))
    rows = of_several_roots(ordered.select("id", "root", F.explode(kept).alias("e")).select("id", "root", "e.segment", "e.pivot"))
    return rows.select(F.col("id").alias("a"), F.col("pivot").alias("b"), "root").distinct()


def remaining_pairs(
    met: DataFrame,
    sharing: DataFrame,
    sized: DataFrame,
    found: tuple[DataFrame, DataFrame],
    roots: DataFrame,
    cut: DataFrame,
    p: int,
    q: int,
) -> DataFrame:
    """Pairs a < b of sets that share a segment, are of different components and may be similar. ``found``: the likely pairs
    of a set and its pivot, compared. Neither set is the pivot, so a segment matters if other sets than it are of several."""
    rows = met.filter("id != pivot").join(roots.withColumnRenamed("doc", "id"), "id", "left").withColumn("root", F.coalesce("root", "id"))
    rows = staged(of_several_roots(rows.join(sharing.select("id", "empty"), "id")), "mixed")
    of_few = pairs_of_few(rows.filter(F.col("holders") <= FEW))
    around = staged(around_pivots(rows.filter(F.col("holders") > FEW).drop("holders")), "mixed")
    others = sized.filter("NOT likely").join(around, ["a", "b"], "left_semi")
    more, more_parts = compared(staged(others, "pairs"), cut, p, q)
    known = found[0].unionByName(more).select("a", "b", "n", (F.col("n") + F.col("m") - 2 * F.col("overlap")).alias("delta"))
    around = staged(around.join(known, ["a", "b"]), "mixed")
    differing = found[1].unionByName(more_parts).filter("size(items) > 0").join(around, ["a", "b"])
    deltas = differing.select(F.col("b").alias("pivot"), F.col("a").alias("id"), "root", "n", "delta", F.explode("items").alias("item"))
    return of_few.unionByName(delta_pairs(staged(deltas, "deltas"), p, q)).distinct()


def texts_of(docs: DataFrame, needed: DataFrame) -> DataFrame:
    """id, low, high, text of the rows that have the keys of the needed sets."""
    wanted = needed.select("id", "low", "high", "smallest")
    if needed.count() <= BROADCAST_KEYS:
        wanted = F.broadcast(wanted)
    return docs.join(wanted, F.col("key").eqNullSafe(F.col("smallest"))).select("id", "low", "high", "text")


def similar_sets(sets: DataFrame, docs: DataFrame, size: int, p: int, q: int) -> DataFrame | None:
    """doc, root of the sets that are linked with others; None if there are none."""
    met = with_pivots(sets.select("id", F.explode("segments").alias("segment")))
    lists = met.groupBy("id").agg(F.collect_list("segment").alias("segments"))
    sharing = staged(sets.select("id", "low", "high", "smallest", "n", "kind", "empty").join(lists, "id"), "sharing-sets")
    sized = sized_pairs(met.filter("id != pivot").select(F.col("id").alias("a"), F.col("pivot").alias("b")).distinct(), sharing, p, q)
    # The sets of likely pairs, and of segments that more than two sets have.
    ends = sized.filter("likely").select(F.explode(F.array("a", "b")).alias("id"))
    several = met.groupBy("segment").agg(F.count("*").alias("holders")).filter("holders > 2").select("segment")
    ends = ends.unionByName(met.join(several, "segment").select("id")).distinct()
    needed = staged(sharing.join(ends, "id", "left_semi").select("id", "low", "high", "smallest"), "compared-sets")
    cut = staged(segments(texts_of(docs, needed), size, p, q), "segments")
    names = cut.filter("fragment = 0").groupBy("id", "cut").agg(F.count("*").alias("times"))
    if not names.filter("times > 1").isEmpty():  # rows with equal keys and texts
        cut = staged(cut.dropDuplicates(["id", "cut", "fragment"]), "segments")

    found = compared(staged(sized.filter("likely"), "pairs"), cut, p, q)
    links = found[0].filter("similar").select("a", "b")
    roots = staged(components(links), "components") if not links.isEmpty() else sets.select(F.col("id").alias("doc"), F.col("id").alias("root")).limit(0)
    rest = sized_pairs(remaining_pairs(met, sharing, sized, found, roots, cut, p, q), sharing, p, q)
    rest = compared(staged(rest.filter("close"), "pairs"), cut, p, q)[0].filter("similar").select("a", "b")
    if not rest.isEmpty():
        known = roots.filter("doc != root").select(F.col("doc").alias("a"), F.col("root").alias("b"))
        return staged(components(known.unionByName(rest)), "components")
    return None if links.isEmpty() else roots


def jaccard_components(
    docs: DataFrame, key: str = "doc_id", text: str = "text", size: int = SIZE, p: int = NUMERATOR, q: int = DENOMINATOR
) -> DataFrame:
    """Per row: ``key``, n_shingles, component_id (smallest key reachable by links of similarity p / q or more)."""
    rows = docs.select(F.col(key).cast("long").alias("key"), F.col(text).alias("text"))
    drawn = staged(sketches(rows, size, p, q), "sketches")
    name = ["low", "high", "n"]
    groups = drawn.filter("n > 0").groupBy(*name).agg(F.min("key").alias("smallest"), *[F.first(c).alias(c) for c in ("kind", "empty", "segments")])
    sets = staged(groups.withColumn("id", F.monotonically_increasing_id()), "sets")
    roots = similar_sets(sets, rows, size, p, q)
    named = sets.select("id", *name, "smallest")
    if roots is not None:
        named = named.join(roots.withColumnRenamed("doc", "id"), "id", "left").withColumn("root", F.coalesce("root", "id"))
        named = staged(named, "rooted")
        least = named.groupBy("root").agg(F.min("smallest").alias("component_id"))
        named = named.join(least, "root").select(*name, "component_id")
    else:
        named = named.select(*name, F.col("smallest").alias("component_id"))
    # Stored, so that the last join is one of plain shuffles and Spark can split the copies of one text.
    named = staged(named, "named-sets")
    bare = drawn.filter("n = 0").select("key", "n", F.col("key").alias("component_id"))
    found = drawn.filter("n > 0").select("key", *name).join(named, name).select("key", "n", "component_id")
    return found.unionByName(bare).select(F.col("key").alias(key), F.col("n").alias("n_shingles"), "component_id")


def op13_jaccard_components(spark: SparkSession, sf_dir: str) -> DataFrame:
    return jaccard_components(table(spark, sf_dir, "documents"))


OP13_SQL = rf"""
WITH RECURSIVE words AS MATERIALIZED (
  SELECT doc_id, regexp_extract_all(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x20\x09-\x0D]+') AS w
  FROM documents
),
shingles AS MATERIALIZED (
  SELECT DISTINCT doc_id, unnest(
    CASE WHEN len(w) < {SIZE} THEN [array_to_string(w, ' ')]
         ELSE [array_to_string(w[i : i + {SIZE} - 1], ' ') for i in range(1, len(w) - {SIZE} + 2)] END) AS shingle
  FROM words WHERE len(w) > 0
),
sizes AS MATERIALIZED (SELECT doc_id, count(*) AS n FROM shingles GROUP BY doc_id),
links AS MATERIALIZED (
  SELECT a.doc_id AS a, b.doc_id AS b FROM shingles a JOIN shingles b USING (shingle)
  JOIN sizes x ON x.doc_id = a.doc_id JOIN sizes y ON y.doc_id = b.doc_id
  WHERE a.doc_id <> b.doc_id AND 10 * least(x.n, y.n) >= 9 * greatest(x.n, y.n)
  GROUP BY a.doc_id, b.doc_id, x.n, y.n HAVING 100 * count(*) >= 90 * (x.n + y.n - count(*))
),
reached AS (
  SELECT doc_id, doc_id AS other FROM documents
  UNION
  SELECT reached.doc_id, links.b FROM reached JOIN links ON links.a = reached.other
)
SELECT doc_id, coalesce(any_value(n), 0) AS n_shingles, min(other) AS component_id
FROM reached LEFT JOIN sizes USING (doc_id) GROUP BY doc_id
"""
