"""Exact dedup by Golomb-coded fingerprint exchange.

1. Rows are written once, dealt into chunks of a bounded number of rows and bucketed by chunk.
2. Each chunk sends its sorted, Golomb-coded fingerprints to the owners of the fingerprint ranges.
3. Owners answer with a bitmap of the fingerprints that occur more than once.
4. Each chunk applies its bitmaps to its own rows. The bucketed table is joined where it lies, so
   texts that occur once are never shuffled.
5. Only suspects travel: they are grouped by their whole bytes, after a reduction in each task.

Texts are equal when identical after lower-casing A-Z; NULL counts as empty. Of equal texts the
row with the largest doc_id stays (a NULL doc_id loses to any other; of rows repeated with one
doc_id, one stays). An empty table gives no rows. Other columns, whatever their names, are carried
along and never looked at.
"""

from __future__ import annotations

import uuid

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from flowlake.llm import coding
from flowlake.llm.common import lower_ascii, parts_of, power_of_two, written
from flowlake.session import work_dir

CHUNK_BITS = 14
FINGERPRINT_BITS = 60
OWNER_ROWS = 500_000

MESSAGE = pa.schema([
    ("chunk", pa.int64()), ("owner", pa.int64()), ("n", pa.int64()), ("width", pa.int32()),
    ("unary", pa.binary()), ("rest", pa.binary()),
])


def _dealt(docs: DataFrame) -> DataFrame:
    """The rows, written with chunk, place in the chunk and digest, bucketed by chunk."""
    spark = docs.sparkSession
    text = lower_ascii(F.coalesce(F.col("row.text"), F.lit("")))
    # A nested column keeps names of the input apart from the ones added here.
    nested = docs.select(F.struct(*[docs[c] for c in docs.columns]).alias("row"))
    rows = nested.select(
        "row", F.sha2(text, 256).alias("sha"), F.monotonically_increasing_id().alias("place")
    ).select(
        "row", "sha", "place",
        F.shiftright("place", CHUNK_BITS).alias("chunk"),
        F.conv(F.substring("sha", 1, FINGERPRINT_BITS // 4), 16, 10).cast("long").alias("print"),
    )
    name = f"exact_dedup_{uuid.uuid4().hex}"
    (
        rows.write.bucketBy(parts_of(spark), "chunk")
        .option("path", work_dir(spark, "exact-rows")).saveAsTable(name)
    )
    return spark.table(name)


def _encoder(bits: int, owner_bits: int):
    drop, inner = np.uint64(FINGERPRINT_BITS - bits), np.uint64(bits - owner_bits)

    def encode(table: pa.Table) -> pa.Table:
        prints = np.sort(table["print"].to_numpy().astype(np.uint64) >> drop)
        owners = (prints >> inner).astype(np.int64)
        values = prints & np.uint64((1 << int(inner)) - 1)
        found, begin = np.unique(owners, return_index=True)
        chunk, rows = table["chunk"][0].as_py(), []
        for owner, part in zip(found.tolist(), np.split(values, begin[1:])):
            rows.append((chunk, owner, len(part), *coding.encode(part)))
        return pa.Table.from_arrays([pa.array(c, t.type) for c, t in zip(zip(*rows), MESSAGE)], schema=MESSAGE)

    return encode


BITMAP = pa.schema([("chunk", pa.int64()), ("owner", pa.int64()), ("n", pa.int64()), ("bitmap", pa.binary())])


def _answer(table: pa.Table) -> pa.Table:
    """For each message of an owner, which of its fingerprints any message has once more."""
    messages = table.to_pylist()
    parts = [coding.decode(m["n"], m["width"], m["unary"], m["rest"]) for m in messages]
    values, counts = np.unique(np.concatenate(parts), return_counts=True)
    more = values[counts > 1]
    rows = [
        (m["chunk"], m["owner"], m["n"], np.packbits(np.isin(p, more)).tobytes())
        for m, p in zip(messages, parts)
    ]
    return pa.Table.from_arrays([pa.array(c, t.type) for c, t in zip(zip(*rows), BITMAP)], schema=BITMAP)


def _receiver(bits: int):
    drop = np.uint64(FINGERPRINT_BITS - bits)

    def receive(rows: pa.Table, bitmaps: pa.Table) -> pa.Table:
        """One bit for each place of the chunk, as 64-bit words; nothing where no row is a suspect."""
        schema = pa.schema([("chunk", pa.int64()), ("words", pa.list_(pa.int64()))])
        if not rows.num_rows:
            return schema.empty_table()
        order = np.argsort(rows["print"].to_numpy().astype(np.uint64) >> drop, kind="stable")
        answers = sorted(bitmaps.to_pylist(), key=lambda m: m["owner"])
        flags = np.concatenate(
            [np.unpackbits(np.frombuffer(m["bitmap"], np.uint8), count=m["n"]) for m in answers]
        )
        if len(flags) != rows.num_rows:
            raise ValueError("a chunk's bitmaps do not fit its rows")
        if not flags.any():
            return schema.empty_table()
        place = rows["place"].to_numpy() & ((1 << CHUNK_BITS) - 1)
        marks = np.zeros((int(place.max()) // 64 + 1) * 64, np.uint8)
        marks[place[order]] = flags
        words = np.packbits(marks, bitorder="little").view("<i8")
        return pa.table([[rows["chunk"][0].as_py()], [words.tolist()]], schema=schema)

    return receive


class Classes:
    """The written rows, split into those whose text occurs once and the verified groups of the rest."""

    def __init__(self, docs: DataFrame, bits: int | None = None):
        """``bits`` of the exchanged fingerprints; by default ten more than the row count needs, so
        that about one row in a thousand is a false suspect."""
        rows = _dealt(docs)
        total = rows.count()
        bits = bits or min(FINGERPRINT_BITS, power_of_two(total) + 10)
        owners = max(parts_of(docs.sparkSession), total / OWNER_ROWS)
        owner_bits = min(bits, power_of_two(owners))
        messages = rows.select("chunk", "print").groupBy("chunk").applyInArrow(
            _encoder(bits, owner_bits),
            "chunk long, owner long, n long, width int, unary binary, rest binary",
        )
        bitmaps = messages.groupBy("owner").applyInArrow(
            _answer, "chunk long, owner long, n long, bitmap binary"
        )
        words = rows.select("chunk", "place", "print").groupBy("chunk").cogroup(
            bitmaps.groupBy("chunk")
        ).applyInArrow(_receiver(bits), "chunk long, words array<long>")
        marks = written(words, "exact-marks")
        inside = F.col("place").bitwiseAND((1 << CHUNK_BITS) - 1)
        word = F.try_element_at("words", (F.shiftright(inside, 6) + 1).cast("int"))
        flag = F.coalesce(F.getbit(word, inside.bitwiseAND(63).cast("int")) == 1, F.lit(False))
        marked = rows.join(marks.hint("shuffle_hash"), "chunk", "left").select(
            "row", "sha", "place", flag.alias("suspect")
        )
        self.once = marked.filter(~F.col("suspect"))
        self.suspects = marked.filter("suspect")
        self.groups = self._verified()

    def _verified(self) -> DataFrame:
        """(sha, keep_id, keep_place, group_size, texts, text) of each group of equal bytes."""
        text = lower_ascii(F.coalesce(F.col("row.text"), F.lit("")))
        equal = (
            self.suspects.select("sha", "place", F.col("row.doc_id").alias("id"), text.alias("text"))
            .groupBy("sha", "text")
            .agg(
                F.max("id").alias("keep_id"),
                F.coalesce(F.max_by("place", "id"), F.max("place")).alias("keep_place"),
                F.count("*").alias("group_size"),
            )
        )
        self.clashes = False
        groups = written(equal.drop("text"), "exact-groups")
        if groups.groupBy("sha").count().filter("count > 1").limit(1).count():
            # Different texts of one digest: the text itself becomes part of the key.
            self.clashes, groups = True, written(equal, "exact-groups")
        return groups

    def _with_group(self) -> DataFrame:
        suspects = self.suspects
        if not self.clashes:
            return suspects.join(self.groups, "sha")
        text = lower_ascii(F.coalesce(F.col("row.text"), F.lit("")))
        return suspects.withColumn("text", text).join(self.groups, ["sha", "text"])

    def report(self) -> DataFrame:
        once = self.once.select(
            F.col("row.doc_id").alias("doc_id"), F.col("row.doc_id").alias("keep_id"),
            F.lit(1).cast("long").alias("group_size"), F.lit(True).alias("kept"),
            F.col("sha").alias("text_sha256"),
        )
        more = self._with_group().select(
            F.col("row.doc_id").alias("doc_id"), "keep_id", "group_size",
            (F.col("place") == F.col("keep_place")).alias("kept"),
            F.col("sha").alias("text_sha256"),
        )
        return once.unionByName(more)

    def kept(self) -> DataFrame:
        """The input's columns of the rows that stay."""
        places = self.groups.select(F.col("keep_place").alias("place"))
        more = self.suspects.join(places, "place", "left_semi")
        return self.once.select("row.*").unionByName(more.select("row.*"))


def exact_dedup(docs: DataFrame, bits: int | None = None) -> DataFrame:
    """One row per input row: doc_id, keep_id, group_size, kept, text_sha256 of the normalised text."""
    return Classes(docs, bits).report()


def drop_copies(docs: DataFrame) -> DataFrame:
    """The rows of ``docs`` that exact dedup keeps, with all their columns."""
    return Classes(docs).kept()
