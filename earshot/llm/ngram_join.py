"""Exact Jaccard self-join of documents on word shingles, by grouped prefixes.

A document is the set of its different 5-word shingles (as 64-bit hashes).  Two documents are
linked if the intersection has at least 80 % of the union.

1. Shingles are counted over all documents.  The (at most ``MOST_COMMON``) shingles in the most
   documents come last in the order of shingles, so that shared passages do not select.
2. A document's prefix is what it must share one shingle of with any partner.  Documents of
   equal prefix and size form a group; a group is listed once under each shingle of its prefix.
3. Shingles with more than one group are kept.  Each list first pairs a leader (a long list:
   some) with the others of about its size; pairs that share enough shingles are expanded to
   members and verified, and the verified ones joined to components; those left alone try the
   members nearest to them by a part of the shingles.  Then all pairs of a list
   that are still in different components are filtered by size, by position and by the number
   of shingles their prefixes share, and verified as well.  Pairs within a component need no
   test, so a large group of near copies costs about its size and not its square.
4. The components of all verified links are the result.  Exact copies (equal sets) are one
   member.

All counts, lists and verifications are Spark shuffles; lists travel as packed blocks of sorted
numbers, dealt by shingle to as many buckets as the input needs.  The driver sees counts and
the table of the commonest shingles (16 MB at most), no documents, links or components.

Null text is empty; a document without words has no shingles and no links.  Rows that share
an id count as one document: what either links to is one component.  Rows without an id are
not linked; their component is null.  Other columns are carried along by
``keep_representatives`` only.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from earshot.llm import text_arrays
from earshot.llm.common import lean, lean_rows
from earshot.llm.components import connected_components
from earshot.session import SHUFFLE_CLEANUP, scratch_path, settings

#: Words of a shingle, and the least similarity in percent.
WORDS = 5
PERCENT = 80
#: At most so many shingles are ordered by their counts; they go to each task.
MOST_COMMON = 1 << 20
#: Below this count a shingle is not common.
LEAST_COMMON = 64
#: Bytes of text whose shingles meet in one bucket.
BUCKET_BYTES = 64 << 20
#: Groups of a list that make it a long one, and leaders that long lists have.
LONG_LIST = 64
LEADERS = 32
#: Bits of a shingle within its bucket that are counted.
CODE_BITS = 24

LIST_SCHEMA = (
    "kind int, shingle long, group_id long, size int, place int, other long, other_size int, "
    "doc_id long, mark1 long, mark2 long"
)
DOC, LISTED, LEADER = 0, 1, 2


def least_overlap(size_a: int, size_b: int, percent: int = PERCENT) -> int:
    """The least intersection of linked sets of these sizes."""
    return -(-percent * (size_a + size_b) // (100 + percent))


def prefix_length(sizes: np.ndarray, percent: int = PERCENT) -> np.ndarray:
    """How many first shingles hold one of every partner's; zero for an empty set."""
    return np.where(sizes > 0, sizes - -(-percent * sizes // 100) + 1, 0)


def shingle_sets(texts: text_arrays.Texts, size: int = WORDS) -> tuple[np.ndarray, np.ndarray]:
    """The different shingles of each text of a chunk, as (text, shingle) in order of both."""
    first, behind, row = text_arrays.words(texts)
    hashes = text_arrays.word_hashes(texts, first, behind)
    found, rows = text_arrays.shingle_hashes(hashes, row, len(texts.starts), size)
    order = np.lexsort((found, rows))
    found, rows = found[order], rows[order]
    new = np.ones(len(found), bool)
    new[1:] = (found[1:] != found[:-1]) | (rows[1:] != rows[:-1])
    return rows[new], found[new]


def pack_sorted(values: np.ndarray) -> bytes:
    """Sorted unsigned numbers as the byte planes of their differences (small when compressed)."""
    if not len(values):
        return b""
    steps = np.diff(values, prepend=np.uint64(0))
    return np.ascontiguousarray(steps.view(np.uint8).reshape(-1, 8).T).tobytes()


def unpack_sorted(raw: bytes) -> np.ndarray:
    planes = np.frombuffer(raw, np.uint8).reshape(8, -1)
    return np.cumsum(np.ascontiguousarray(planes.T).view(np.uint64).ravel(), dtype=np.uint64)


def pack_plain(values: np.ndarray) -> bytes:
    """Numbers as byte planes."""
    raw = np.ascontiguousarray(values).view(np.uint8).reshape(len(values), -1)
    return np.ascontiguousarray(raw.T).tobytes()


def unpack_plain(raw: bytes, kind: type, n: int) -> np.ndarray:
    planes = np.frombuffer(raw, np.uint8).reshape(-1, n) if n else np.zeros((8, 0), np.uint8)
    return np.ascontiguousarray(planes.T).view(kind).ravel()


def bucket_bits(docs: DataFrame, text: str) -> int:
    """Bits of a shingle that name its bucket: as many buckets as the input needs."""
    total = docs.agg(F.sum(F.octet_length(F.col(f"`{text}`"))).alias("n")).first()["n"] or 0
    least = int(docs.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    return max(1, max(least - 1, int(total // BUCKET_BYTES)).bit_length())


def common_shingles(docs: DataFrame, text: str, bits: int) -> np.ndarray:
    """The codes of the commonest shingles, rarest first among them.

    A code is the first ``bits + CODE_BITS`` bits of a shingle; its count is that of all
    documents whose set has a shingle with it.
    """

    @lean
    def counted(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in text_arrays.parts(batches, 0):
            codes = [
                shingle_sets(t)[1] >> np.uint64(64 - bits - CODE_BITS)
                for t in text_arrays.chunks(batch.column(0))
            ]
            codes = np.sort(np.concatenate(codes)) if codes else np.zeros(0, np.uint64)
            buckets = codes >> np.uint64(CODE_BITS)
            names, begins = np.unique(buckets, return_index=True)
            ends = np.append(begins[1:], len(codes))
            yield pa.RecordBatch.from_arrays(
                [
                    pa.array(names.astype(np.int64)),
                    pa.array(
                        [pack_sorted(codes[b:e]) for b, e in zip(begins, ends, strict=True)],
                        pa.binary(),
                    ),
                ],
                names=["bucket", "codes"],
            )

    @lean
    def frequent(block: pa.Table) -> pa.Table:
        codes = np.sort(np.concatenate([unpack_sorted(x.as_py()) for x in block.column("codes")]))
        names, counts = np.unique(codes, return_counts=True)
        often = counts >= LEAST_COMMON
        # The number of all codes of the bucket goes along in a row of its own.
        return pa.table(
            {
                "code": pa.array(np.append(names[often].astype(np.int64), -1)),
                "n": pa.array(np.append(counts[often], len(codes))),
            }
        )

    counts = (
        docs.select(F.col(f"`{text}`").cast("string").alias("text"))
        .mapInArrow(counted, "bucket long, codes binary")
        .groupBy("bucket")
        .applyInArrow(frequent, "code long, n long")
    )
    path = scratch_path(docs.sparkSession, "shingle-counts")
    counts.write.parquet(path)
    counts = docs.sparkSession.read.parquet(path)
    total = counts.where("code < 0").agg(F.sum("n").alias("n")).first()["n"] or 0
    # Not more than total / least codes can be in so many documents.
    least = max(LEAST_COMMON, -(-total // MOST_COMMON))
    common = counts.where((F.col("code") >= 0) & (F.col("n") >= least)).select("code", "n").toArrow()
    codes = common.column("code").to_numpy().astype(np.uint64)
    return codes[np.lexsort((codes, common.column("n").to_numpy()))]


class Order:
    """The order of shingles: uncommon ones by hash, then the common ones by count."""

    def __init__(self, common: np.ndarray, bits: int) -> None:
        self.shift = np.uint64(64 - bits - CODE_BITS)
        self.by_code = np.argsort(common, kind="stable")
        self.codes = common[self.by_code]
        # A quick test that passes all common codes.
        self.maybe = np.zeros(1 << 20, bool)
        self.maybe[(self.codes & np.uint64((1 << 20) - 1)).astype(np.int64)] = True

    def ranks(self, shingles: np.ndarray) -> np.ndarray:
        """Zero for an uncommon shingle, one and more for the common ones."""
        out = np.zeros(len(shingles), np.int64)
        if not len(self.codes):
            return out
        codes = shingles >> self.shift
        at = np.flatnonzero(self.maybe[(codes & np.uint64((1 << 20) - 1)).astype(np.int64)])
        place = np.minimum(np.searchsorted(self.codes, codes[at]), len(self.codes) - 1)
        hit = self.codes[place] == codes[at]
        out[at[hit]] = self.by_code[place[hit]] + 1
        return out


MARK = np.uint64(0x51ED270B)


def _sums(values: np.ndarray, begin: np.ndarray) -> np.ndarray:
    """The sum (modulo 2**64) of each run of values; ``begin`` has the runs' ends as well."""
    total = np.concatenate([np.zeros(1, np.uint64), np.cumsum(values, dtype=np.uint64)])
    return total[begin[1:]] - total[begin[:-1]]


def prefixes(texts: text_arrays.Texts, order: Order) -> tuple[np.ndarray, ...]:
    """For each text its size, group and two fingerprints; and the prefix entries of all.

    An entry is (shingle, text, place from one).  The fingerprints are sums of differently
    mixed shingles and, with the size, stand for the set.
    """
    n = len(texts.starts)
    rows, found = shingle_sets(texts)
    sizes = np.bincount(rows, minlength=n)
    begin = np.concatenate([[0], np.cumsum(sizes)])

    mark1 = _sums(text_arrays.mix(found ^ MARK), begin)
    mark2 = _sums(text_arrays.mix(found + np.uint64(0x9E3779B97F4A7C15)), begin)
    ranks = order.ranks(found)
    # Rows are in order already; only those with common shingles change.
    if ranks.any():
        resort = np.lexsort((found, ranks, rows))
        found = found[resort]
    place = np.arange(len(found)) - begin[rows] + 1
    inside = place <= prefix_length(sizes)[rows]
    found, rows, place = found[inside], rows[inside], place[inside]
    taken = np.concatenate([[0], np.cumsum(np.bincount(rows, minlength=n))])
    sums = _sums(text_arrays.mix(found * np.uint64(3)), taken)
    group = text_arrays.mix(sums + sizes.astype(np.uint64))
    return sizes, group, mark1, mark2, found, rows, place


def group_lists(docs: DataFrame, common: np.ndarray, bits: int, doc_id: str, text: str) -> DataFrame:
    """Rows of three kinds: documents, groups listed under a shingle, and leader pairs."""
    shared = docs.sparkSession.sparkContext.broadcast(common)

    @lean
    def listed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        order = Order(shared.value, bits)
        for batch in text_arrays.parts(batches, 1):
            parts = [prefixes(t, order) for t in text_arrays.chunks(batch.column(1))]
            if not parts:
                continue
            sizes, group, mark1, mark2 = (np.concatenate([p[k] for p in parts]) for k in range(4))
            shift = np.cumsum([0] + [len(p[0]) for p in parts])
            found = np.concatenate([p[4] for p in parts])
            rows = np.concatenate([p[5] + s for p, s in zip(parts, shift, strict=False)])
            place = np.concatenate([p[6] for p in parts])
            # Copies within the batch are listed once.
            resort = np.lexsort((group[rows], found))
            found, rows, place = found[resort], rows[resort], place[resort]
            new = np.ones(len(found), bool)
            new[1:] = (found[1:] != found[:-1]) | (group[rows][1:] != group[rows][:-1])
            found, rows, place = found[new], rows[new], place[new]
            buckets = (found >> np.uint64(64 - bits)).astype(np.int64)
            names, begins = np.unique(buckets, return_index=True)
            ends = np.append(begins[1:], len(found))
            raw = [
                (
                    pack_sorted(found[b:e]),
                    pack_plain(group[rows[b:e]]),
                    pack_plain(sizes[rows[b:e]].astype(np.uint32)),
                    pack_plain(place[b:e].astype(np.uint32)),
                )
                for b, e in zip(begins, ends, strict=True)
            ]
            columns = [pa.array([r[k] for r in raw], pa.binary()) for k in range(4)]
            yield pa.RecordBatch.from_arrays(
                [pa.array(names), *columns, pa.nulls(len(names), pa.binary())],
                names=["bucket", "shingles", "groups", "sizes", "places", "docs"],
            )
            # The documents themselves, dealt by group.
            ids = batch.column(0)
            home = (group >> np.uint64(64 - bits)).astype(np.int64)
            names, which = np.unique(home, return_inverse=True)
            inner = []
            for k in range(len(names)):
                at = np.flatnonzero(which == k)
                inner.append(
                    _to_bytes(
                        pa.table(
                            {
                                "doc_id": ids.take(pa.array(at)),
                                "size": sizes[at].astype(np.int32),
                                "group_id": group[at].view(np.int64),
                                "mark1": mark1[at].view(np.int64),
                                "mark2": mark2[at].view(np.int64),
                            }
                        )
                    )
                )
            none = pa.nulls(len(names), pa.binary())
            yield pa.RecordBatch.from_arrays(
                [pa.array(names), none, none, none, none, pa.array(inner, pa.binary())],
                names=["bucket", "shingles", "groups", "sizes", "places", "docs"],
            )

    @lean
    def joined(block: pa.Table) -> pa.Table:
        documents = [_from_bytes(x.as_py()) for x in block.column("docs") if x.is_valid]
        lists = [
            (unpack_sorted(s.as_py()), g.as_py(), z.as_py(), p.as_py())
            for s, g, z, p in zip(*(block.column(k) for k in ("shingles", "groups", "sizes", "places")), strict=True)
            if s.is_valid
        ]
        found = np.concatenate([x[0] for x in lists] or [np.zeros(0, np.uint64)])
        parts = [[], [], []]
        for shingles, *raw in lists:
            for k, (value, kind) in enumerate(zip(raw, (np.uint64, np.uint32, np.uint32), strict=True)):
                parts[k].append(unpack_plain(value, kind, len(shingles)))
        group, size, place = (
            np.concatenate(p) if p else np.zeros(0, kind)
            for p, kind in zip(parts, (np.uint64, np.uint32, np.uint32), strict=True)
        )
        resort = np.lexsort((group, found))
        found, group, size, place = found[resort], group[resort], size[resort], place[resort]
        new = np.ones(len(found), bool)
        new[1:] = (found[1:] != found[:-1]) | (group[1:] != group[:-1])
        found, group, size, place = found[new], group[new], size[new], place[new]
        several = np.zeros(len(found), bool)
        several[1:] = found[1:] == found[:-1]
        several[:-1] |= several[1:]
        found, group, size, place = found[several], group[several], size[several], place[several]
        leader, member, leader_size, member_size, shared = _leader_pairs(found, group, size)
        n, m = len(found), len(leader)
        # A leader pair has the number of shared shingles as its place.
        out = pa.table(
            {
                "kind": np.concatenate([np.full(n, LISTED), np.full(m, LEADER)]).astype(np.int32),
                "shingle": np.concatenate([found.view(np.int64), np.zeros(m, np.int64)]),
                "group_id": np.concatenate([group.view(np.int64), leader.view(np.int64)]),
                "size": np.concatenate([size, leader_size]).astype(np.int32),
                "place": np.concatenate([place, shared]).astype(np.int32),
                "other": np.concatenate([np.zeros(n, np.int64), member.view(np.int64)]),
                "other_size": np.concatenate([np.zeros(n, np.uint32), member_size]).astype(np.int32),
                "doc_id": pa.nulls(n + m, pa.int64()),
                "mark1": np.zeros(n + m, np.int64),
                "mark2": np.zeros(n + m, np.int64),
            }
        )
        if documents:
            docs = pa.concat_tables(documents)
            k = len(docs)
            docs = pa.table(
                {
                    "kind": np.full(k, DOC, np.int32),
                    "shingle": np.zeros(k, np.int64),
                    "group_id": docs.column("group_id"),
                    "size": docs.column("size"),
                    "place": np.zeros(k, np.int32),
                    "other": np.zeros(k, np.int64),
                    "other_size": np.zeros(k, np.int32),
                    "doc_id": docs.column("doc_id"),
                    "mark1": docs.column("mark1"),
                    "mark2": docs.column("mark2"),
                }
            )
            out = pa.concat_tables([out, docs])
        return out

    return (
        docs.select(
            F.col(f"`{doc_id}`").cast("long").alias("doc_id"),
            F.col(f"`{text}`").cast("string").alias("text"),
        )
        .mapInArrow(
            listed,
            "bucket long, shingles binary, groups binary, sizes binary, places binary, docs binary",
        )
        .groupBy("bucket")
        .applyInArrow(joined, LIST_SCHEMA)
    )


def _to_bytes(rows: pa.Table) -> bytes:
    sink = pa.BufferOutputStream()
    with pa.ipc.new_stream(sink, rows.schema) as writer:
        writer.write_table(rows)
    return sink.getvalue().to_pybytes()


def _from_bytes(raw: bytes) -> pa.Table:
    return pa.ipc.open_stream(raw).read_all()


def _leader_pairs(found: np.ndarray, group: np.ndarray, size: np.ndarray) -> tuple[np.ndarray, ...]:
    """In each list and band of sizes, the smallest group paired with each other one.

    A list of more than ``LONG_LIST`` groups has ``LEADERS`` leaders, since in a large group of near
    copies not all are similar to the same one.  Gives leader, member, their sizes and the
    number of lists with the pair.
    """
    band = np.floor(np.log(np.maximum(size, 1)) / np.log(1.2)).astype(np.int64)
    order = np.lexsort((group, band, found))
    f, b, g, z = found[order], band[order], group[order], size[order]
    first = np.ones(len(f), bool)
    first[1:] = (f[1:] != f[:-1]) | (b[1:] != b[:-1])
    begin = np.flatnonzero(first)
    length = np.diff(np.append(begin, len(f)))
    head, long = np.repeat(begin, length), np.repeat(length > LONG_LIST, length)
    rank = np.arange(len(f)) - head
    heads, members = [], []
    for k in range(LEADERS):
        paired = np.flatnonzero((rank > k) & (long if k else True))
        heads.append(head[paired] + k)
        members.append(paired)
    at, paired = np.concatenate(heads), np.concatenate(members)
    leader, member, leader_size, member_size = g[at], g[paired], z[at], z[paired]
    order = np.lexsort((member, leader))
    leader, member = leader[order], member[order]
    new = np.ones(len(leader), bool)
    new[1:] = (leader[1:] != leader[:-1]) | (member[1:] != member[:-1])
    at = np.flatnonzero(new)
    counts = np.diff(np.append(at, len(leader)))
    return leader[at], member[at], leader_size[order][at], member_size[order][at], counts


def reachable(shared: Column, size_a: Column, size_b: Column) -> Column:
    """Whether sets that share so many shingles of their prefixes can be similar enough.

    The prefix that ends first in the order holds no more common shingles than those shared,
    so the intersection is at most their number and what follows that prefix.
    """

    def behind(size: Column) -> Column:
        return F.ceil(PERCENT * size / 100) - 1

    need = F.ceil(PERCENT * (size_a + size_b) / (100 + PERCENT))
    return shared + F.greatest(behind(size_a), behind(size_b)) >= need


#: Bits of the filter that the ids in question are looked up with, 64 in a row.
FILTER_BITS = 1 << 22


def flag_wanted(rows: DataFrame, ids: DataFrame) -> DataFrame:
    """``rows`` with a column ``wanted``: true if ``id`` is among ``ids``, and perhaps for a few more.

    The ids are hashed into a filter of fixed size (65,536 rows at most, so it may be broadcast);
    it saves the other rows from being shuffled.  A null id is not wanted.
    """
    place = F.pmod(F.xxhash64("id"), F.lit(FILTER_BITS))
    word, bit = F.floor(place / 64), F.pmod(place, F.lit(64)).cast("int")
    marked = (
        ids.select(word.alias("word"), F.expr("1L").alias("one"), bit.alias("bit"))
        .groupBy("word")
        .agg(F.bit_or(F.expr("shiftleft(one, bit)")).alias("bits"))
    )
    placed = rows.withColumns({"word": word, "bit": bit}).join(F.broadcast(marked), "word", "left")
    hit = F.col("id").isNotNull() & F.col("bits").isNotNull()
    hit = hit & (F.getbit("bits", F.col("bit")) == 1)
    return placed.withColumn("wanted", F.coalesce(hit, F.lit(False))).drop("word", "bit", "bits")


def verified(
    docs: DataFrame, pairs: DataFrame, doc_id: str, text: str, percent: int = PERCENT
) -> DataFrame:
    """Those of the pairs (a, a_mark, b, b_mark) whose sets are similar enough, as (a, b).

    The texts of the ids in question are looked up, turned to sets and compared.
    """

    @lean
    def sets(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in text_arrays.parts(batches, 1):
            for texts in text_arrays.chunks(batch.column(1)):
                n = len(texts.starts)
                rows, found = shingle_sets(texts)
                begin = np.concatenate([[0], np.cumsum(np.bincount(rows, minlength=n))])
                marks = _sums(text_arrays.mix(found ^ MARK), begin).view(np.int64)
                raw = [found[s:e].tobytes() for s, e in zip(begin, begin[1:], strict=False)]
                yield pa.RecordBatch.from_arrays(
                    [
                        batch.column(0).slice(texts.first, n),
                        pa.array(marks),
                        pa.array(raw, pa.binary()),
                    ],
                    names=["id", "mark", "shingles"],
                )

    @F.arrow_udf("boolean")
    @lean_rows
    def similar(left: pa.Array, right: pa.Array) -> pa.Array:
        out = []
        for x, y in zip(left, right, strict=True):
            a = np.frombuffer(x.as_py(), np.uint64)
            b = np.frombuffer(y.as_py(), np.uint64)
            both = len(a) + len(b) - len(np.union1d(a, b))
            out.append(100 * both >= percent * (len(a) + len(b) - both))
        return pa.array(out, pa.bool_())

    spark = docs.sparkSession
    wanted = pairs.select(F.col("a").alias("id")).union(pairs.select("b"))
    texts = docs.select(
        F.col(f"`{doc_id}`").cast("long").alias("id"),
        F.col(f"`{text}`").cast("string").alias("text"),
    )
    path = scratch_path(spark, "shingle-sets")
    flag_wanted(texts, wanted).where("wanted").select("id", "text").mapInArrow(
        sets, "id long, mark long, shingles binary"
    ).dropDuplicates(["id", "mark"]).write.parquet(path)
    found = spark.read.parquet(path)
    left = found.toDF("a", "a_mark", "left")
    right = found.toDF("b", "b_mark", "right")
    both = pairs.join(right, ["b", "b_mark"]).join(left, ["a", "a_mark"])
    return both.where(similar("left", "right")).select("a", "b")


#: Members of each component look for their nearest ones by the shingles of one hash class of so
#: many, and try so many of them, before all pairs left are looked at.
NEAREST_PART = 8
NEAREST = 8


def _labelled(members: DataFrame, links: DataFrame) -> tuple[DataFrame, DataFrame]:
    """The components of the links, and the members with that component as their label."""
    stars = connected_components(links).where("id <> component_id")
    path = scratch_path(members.sparkSession, "labelled-members")
    (
        members.join(stars.withColumnRenamed("component_id", "label"), "id", "left")
        .select("group_id", "size", "id", "mark", F.coalesce("label", "id").alias("label"))
        .write.parquet(path)
    )
    return stars, members.sparkSession.read.parquet(path)


def _label_range(labelled: DataFrame) -> DataFrame:
    """The smallest and the largest label of each group's members."""
    return labelled.groupBy("group_id").agg(
        F.min("label").alias("low"), F.max("label").alias("high")
    )


def _open_lists(listed: DataFrame, labelled: DataFrame) -> DataFrame:
    """The lists, member by member, that have members of different labels."""
    mixed = (
        listed.join(_label_range(labelled), "group_id")
        .groupBy("shingle")
        .agg(F.min("low").alias("low"), F.max("high").alias("high"))
        .where("low <> high")
        .select("shingle")
    )
    return (
        listed.join(mixed, "shingle", "left_semi")
        .join(labelled.select("group_id", "id", "mark", "label"), "group_id")
        .select("shingle", "size", "place", "id", "mark", "label")
    )


#: Members of one component that meet others together, and pairs that a task counts at a time.
BLOCK_MEMBERS = 256
PAIRS_AT_ONCE = 1 << 20

PAIR_SCHEMA = (
    "x_id long, x_mark long, x_size int, y_id long, y_mark long, y_size int, shared long"
)
_ENDS = ("x_id", "x_mark", "x_size", "y_id", "y_mark", "y_size")


def _can_reach(shared: np.ndarray, size_a: np.ndarray, size_b: np.ndarray) -> np.ndarray:
    """As ``reachable``, for arrays."""
    behind = np.maximum(-(-PERCENT * size_a // 100), -(-PERCENT * size_b // 100)) - 1
    return shared + behind >= -(-PERCENT * (size_a + size_b) // (100 + PERCENT))


def _blocks(open_lists: DataFrame, labelled: DataFrame) -> DataFrame:
    """The members of each list, gathered by label in blocks of about ``BLOCK_MEMBERS``.

    A member's block is that of its hash in every list, so two members always meet in the same
    pair of blocks.
    """
    most = labelled.groupBy("label").count().agg(F.max("count")).first()[0] or 0
    chunk = F.pmod(F.xxhash64("id"), F.lit(-(-most // BLOCK_MEMBERS) or 1)).cast("int")
    return (
        open_lists.withColumn("chunk", chunk)
        .groupBy("shingle", "label", "chunk")
        .agg(
            F.collect_list(F.struct("id", "mark", "size", "place")).alias("members"),
            F.min("size").alias("least"),
            F.max("size").alias("most"),
        )
    )


def _crossed(block: pa.RecordBatch, group: np.ndarray) -> dict[str, np.ndarray]:
    """All pairs of the two blocks of each row that fit in size."""
    sides, counts = {}, {}
    for side in "xy":
        lists = block.column(side)
        counts[side] = np.diff(lists.offsets.to_numpy())
        members = lists.flatten()
        for name in ("id", "mark", "size", "place"):
            sides[f"{side}_{name}"] = members.field(name).to_numpy(zero_copy_only=False)
    rows = counts["x"] * counts["y"]
    row = np.repeat(np.arange(len(rows)), rows)
    within = np.arange(len(row)) - np.repeat(np.cumsum(rows) - rows, rows)
    begin = {side: np.cumsum(counts[side]) - counts[side] for side in "xy"}
    at = {
        "x": begin["x"][row] + within // counts["y"][row],
        "y": begin["y"][row] + within % counts["y"][row],
    }
    out = {name: values[at[name[0]]] for name, values in sides.items()}
    x, y = out["x_size"].astype(np.int64), out["y_size"].astype(np.int64)
    need = -(-PERCENT * (x + y) // (100 + PERCENT))
    reach = np.minimum(x - out.pop("x_place"), y - out.pop("y_place")) + 1
    fits = (100 * x >= PERCENT * y) & (100 * y >= PERCENT * x)
    out |= {"first": reach >= need, "group": group[row], "shared": np.ones(len(row), np.int64)}
    return {name: values[fits] for name, values in out.items()}


def _added(pairs: dict[str, np.ndarray]) -> dict[str, np.ndarray]:
    """Equal pairs as one: their numbers of lists added, and whether any was a first one."""
    order = np.lexsort(tuple(pairs[k] for k in ("y_mark", "y_id", "x_mark", "x_id", "group")))
    pairs = {name: values[order] for name, values in pairs.items()}
    new = np.zeros(len(order), bool)
    new[:1] = True
    for name in ("group", "x_id", "x_mark", "y_id", "y_mark"):
        new[1:] |= pairs[name][1:] != pairs[name][:-1]
    at = np.flatnonzero(new)
    if not len(at):
        return pairs
    out = {name: values[at] for name, values in pairs.items()}
    out["shared"] = np.add.reduceat(pairs["shared"], at)
    out["first"] = np.logical_or.reduceat(pairs["first"], at)
    return out


def _best(pairs: dict[str, np.ndarray], most: int) -> np.ndarray:
    """Whether a pair is among the ``most`` of its group that share most with either end."""
    kept = np.zeros(len(pairs["shared"]), bool)
    for side in "xy":
        ends = [pairs[k] for k in (f"{side}_mark", f"{side}_id", "group")]
        order = np.lexsort((pairs["y_id"], pairs["x_id"], -pairs["shared"], *ends))
        new = np.ones(len(order), bool)
        new[1:] = False
        for end in ends:
            new[1:] |= end[order][1:] != end[order][:-1]
        begin = np.flatnonzero(new)
        rank = np.arange(len(order)) - np.repeat(begin, np.diff(np.append(begin, len(order))))
        kept[order[rank < most]] = True
    return kept


def _met(open_lists: DataFrame, labelled: DataFrame, judge, nearest: int | None = None) -> DataFrame:
    """Pairs of members of different labels that ``judge`` lets pass, with the lists they share.

    Blocks of members meet instead of members, and a task counts their pairs: what leaves it are
    only pairs that ``judge(shared, first, x_size, y_size)`` holds for, ``first`` saying whether
    one of the shingles that they share may be the first one of similar sets.  ``nearest``
    keeps the pairs of each pair of blocks that share most.  A pair of blocks is in one task, which
    holds the counts of one such pair beside the ``PAIRS_AT_ONCE`` pairs it looks at.
    """
    blocks = _blocks(open_lists, labelled)
    x, y = blocks.alias("x"), blocks.alias("y")
    keys = ["x_label", "x_chunk", "y_label", "y_chunk"]
    met = x.join(
        y,
        (F.col("x.shingle") == F.col("y.shingle"))
        & (F.col("x.label") < F.col("y.label"))
        & (100 * F.col("x.most") >= PERCENT * F.col("y.least"))
        & (100 * F.col("y.most") >= PERCENT * F.col("x.least")),
    ).select(
        F.col("x.label").alias("x_label"),
        F.col("x.chunk").alias("x_chunk"),
        F.col("y.label").alias("y_label"),
        F.col("y.chunk").alias("y_chunk"),
        F.col("x.members").alias("x"),
        F.col("y.members").alias("y"),
    )

    @lean
    def counted(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: dict[str, np.ndarray] | None = None
        last, number = None, 0

        def passed(pairs: dict[str, np.ndarray]) -> pa.RecordBatch:
            good = judge(*(pairs[k] for k in ("shared", "first", "x_size", "y_size")))
            pairs = {name: values[good] for name, values in pairs.items()}
            if nearest is not None:
                kept = _best(pairs, nearest)
                pairs = {name: values[kept] for name, values in pairs.items()}
            return pa.RecordBatch.from_arrays(
                [pa.array(pairs[k]) for k in (*_ENDS, "shared")], names=[*_ENDS, "shared"]
            )

        for batch in batches:
            names = np.stack([batch.column(k).to_numpy() for k in range(4)], axis=1)
            changes = np.ones(len(names), bool)
            changes[1:] = (names[1:] != names[:-1]).any(axis=1)
            changes[:1] = last is None or (names[:1] != last).any()
            group = number + np.cumsum(changes)
            if len(names):
                last, number = names[-1], int(group[-1])
            sizes = np.cumsum(
                pc.list_value_length(batch.column(4)).to_numpy().astype(np.int64)
                * pc.list_value_length(batch.column(5)).to_numpy()
            )
            row = 0
            while row < batch.num_rows:
                before = sizes[row - 1] if row else 0
                end = max(row + 1, int(np.searchsorted(sizes, before + PAIRS_AT_ONCE, "right")))
                part = pa.RecordBatch.from_arrays(
                    [batch.column(k).slice(row, end - row) for k in (4, 5)], names=["x", "y"]
                )
                pairs = _crossed(part, group[row:end])
                if held is not None:
                    pairs = {k: np.concatenate([held[k], v]) for k, v in pairs.items()}
                pairs = _added(pairs)
                going_on = pairs["group"] == group[end - 1]
                held = {k: v[going_on] for k, v in pairs.items()}
                yield passed({k: v[~going_on] for k, v in pairs.items()})
                row = end
        if held is not None:
            yield passed(held)

    return met.repartition(*keys).sortWithinPartitions(*keys).mapInArrow(counted, PAIR_SCHEMA)


def _pairs(met: DataFrame) -> DataFrame:
    return met.select("x_id", "x_mark", "y_id", "y_mark").toDF("a", "a_mark", "b", "b_mark")


#: Rows of an Arrow batch: pairs of sets have some ten kilobytes each.
BATCH_ROWS = 1000


def near_duplicates(docs: DataFrame, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """(doc_id, n_shingles, component_id): one row for each row of ``docs``.

    All that runs in Python is done when this returns, in batches of ``BATCH_ROWS`` rows.  Each
    of its many queries gives its shuffle files back when it ends, so the disk holds those of
    one of them at a time, however rarely the driver collects its garbage.
    """
    spark, key = docs.sparkSession, "spark.sql.execution.arrow.maxRecordsPerBatch"
    before = int(spark.conf.get(key))
    rows = min(before, BATCH_ROWS) if before > 0 else BATCH_ROWS
    with settings(spark, {key: str(rows), SHUFFLE_CLEANUP: "true"}):
        return _near_duplicates(docs, doc_id, text)


def _near_duplicates(docs: DataFrame, doc_id: str, text: str) -> DataFrame:
    spark = docs.sparkSession
    bits = bucket_bits(docs, text)
    common = common_shingles(docs, text, bits)
    path = scratch_path(spark, "group-lists")
    group_lists(docs, common, bits, doc_id, text).write.partitionBy("kind").parquet(path)
    stored = spark.read.schema(LIST_SCHEMA).parquet(path)
    every = stored.where(F.col("kind") == DOC).select("doc_id", "size", "group_id", "mark1", "mark2")
    usable = every.where((F.col("size") > 0) & F.col("doc_id").isNotNull())

    # Members: one for each different set, named by its smallest id.
    members = usable.groupBy("group_id", "size", "mark1", "mark2").agg(F.min("doc_id").alias("id"))
    members = members.select("group_id", "size", "id", F.col("mark1").alias("mark"), "mark2")
    path = scratch_path(spark, "members")
    members.write.parquet(path)
    members = spark.read.parquet(path)
    heads = members.groupBy("group_id").agg(F.min(F.struct("id", "mark")).alias("head"))

    inside = (
        members.join(heads, "group_id")
        .where((F.col("id") != F.col("head.id")) | (F.col("mark") != F.col("head.mark")))
        .select("head.id", "head.mark", F.col("id").alias("b"), F.col("mark").alias("b_mark"))
        .toDF("a", "a_mark", "b", "b_mark")
    )
    leaders = (
        stored.where(F.col("kind") == LEADER)
        .groupBy("group_id", "size", "other", "other_size")
        .agg(F.sum("place").alias("shared"))
        .where(reachable(F.col("shared"), F.col("size"), F.col("other_size")))
    )
    across = (
        leaders.join(heads, "group_id")
        .select("head", F.col("other").alias("group_id"))
        .join(members, "group_id")
        .select("head.id", "head.mark", F.col("id").alias("b"), F.col("mark").alias("b_mark"))
        .toDF("a", "a_mark", "b", "b_mark")
    )
    path = scratch_path(spark, "leader-pairs")
    inside.union(across).distinct().write.parquet(path)
    links = verified(docs, spark.read.parquet(path), doc_id, text)
    stars, labelled = _labelled(members, links)
    listed = stored.where(F.col("kind") == LISTED).select("shingle", "group_id", "size", "place")

    # Members that no leader reached try those first that seem nearest by a part of the shingles.
    open_lists = _open_lists(
        listed.where(F.pmod("shingle", F.lit(NEAREST_PART)) == 0), labelled
    )

    def likely(shared, _, x_size, y_size):
        # The whole number is about NEAREST_PART times that of the part; twice as much is allowed for.
        return _can_reach(2 * NEAREST_PART * shared, x_size.astype(np.int64), y_size)

    part = _met(open_lists, labelled, likely, NEAREST)
    order = F.desc("shared"), "x_id", "y_id"
    by_x, by_y = (W.partitionBy(f"{s}_id", f"{s}_mark").orderBy(*order) for s in "xy")
    near = part.select(
        "*", F.row_number().over(by_x).alias("of_x"), F.row_number().over(by_y).alias("of_y")
    )
    path = scratch_path(spark, "nearest-pairs")
    _pairs(near.where(F.least("of_x", "of_y") <= NEAREST)).write.parquet(path)
    more = verified(docs, spark.read.parquet(path), doc_id, text)
    known = stars.select(F.col("id").alias("a"), F.col("component_id").alias("b"))
    stars, labelled = _labelled(members, known.union(more))

    # What is left: pairs of a list, or of a group, in different components.
    def possible(shared, first, x_size, y_size):
        # The first shingle that two sets share must leave enough behind it, and all of them
        # together as well.
        return first & _can_reach(shared, x_size.astype(np.int64), y_size)

    rest = _pairs(_met(_open_lists(listed, labelled), labelled, possible))
    whole = _label_range(labelled)
    parted = whole.where("low <> high").select("group_id")
    split = labelled.join(parted, "group_id", "left_semi")
    x, y = split.alias("x"), split.alias("y")
    within = x.join(
        y,
        (F.col("x.group_id") == F.col("y.group_id")) & (F.col("x.label") < F.col("y.label")),
    ).select("x.id", "x.mark", F.col("y.id").alias("b"), F.col("y.mark").alias("b_mark"))
    path = scratch_path(spark, "open-pairs")
    rest.union(within).distinct().write.parquet(path)
    more = verified(docs, spark.read.parquet(path), doc_id, text)

    # Copies of a set, and the sets of one id, belong together.
    named = members.select("group_id", "size", F.col("mark").alias("mark1"), "mark2", "id")
    copies = (
        usable.join(named, ["group_id", "size", "mark1", "mark2"])
        .where(F.col("doc_id") != F.col("id"))
        .select(F.col("doc_id").alias("a"), F.col("id").alias("b"))
    )
    known = stars.select(F.col("id").alias("a"), F.col("component_id").alias("b"))
    final = connected_components(known.union(more).union(copies))
    return every.join(final.withColumnRenamed("id", "doc_id"), "doc_id", "left").select(
        "doc_id",
        F.col("size").cast("long").alias("n_shingles"),
        F.coalesce("component_id", "doc_id").alias("component_id"),
    )


def keep_representatives(docs: DataFrame, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """``docs`` with one row for each component; rows without an id are all kept.

    Only rows that may have to go are shuffled: those of an id that is not its component's
    smallest, or that occurs more than once.
    """
    found = near_duplicates(docs, doc_id, text).select(F.col("doc_id").alias("id"), "component_id")
    path = scratch_path(docs.sparkSession, "suspects")
    with settings(docs.sparkSession, {SHUFFLE_CLEANUP: "true"}):
        (
            found.where("id IS NOT NULL")
            .groupBy("id")
            .agg(F.min("component_id").alias("component_id"), F.count("*").alias("n"))
            .where("n > 1 OR component_id <> id")
            .write.parquet(path)
        )
    suspects = docs.sparkSession.read.parquet(path)
    others = suspects.where("component_id <> id").select("id")
    names = docs.columns
    rows = docs.select(
        F.struct(*[F.col(f"`{c}`") for c in names]).alias("d"),
        F.col(f"`{doc_id}`").cast("long").alias("id"),
    )
    flagged = flag_wanted(rows, suspects.select("id"))
    checked = (
        flagged.where("wanted")
        .select("d", "id")
        .join(others, "id", "left_anti")
        .dropDuplicates(["id"])
    )
    kept = flagged.where("NOT wanted").select("d").union(checked.select("d"))
    return kept.select(*[F.col(f"d.`{c}`").alias(c) for c in names])
