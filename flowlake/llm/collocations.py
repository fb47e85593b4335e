"""Mining of frequent phrases (collocations) by set-oriented relational mining (SETM).

The occurrences of the words of a corpus are a relation (place, word), sorted by place, where the
words of a piece have places in a row and a place is left out between two pieces. Level by level:

1. the relation of the frequent phrases of k words is joined with itself by merging on adjacent places
   of one piece, which gives the occurrences of phrases of k + 1 words;
2. they are grouped and counted, in each block first and then over all blocks;
3. a semi-join with the frequent groups leaves the next relation, which is written before the next
   level extends it.

A relation is kept as sorted, compressed arrays, one block of about ``BLOCK_WORDS`` words to a row. A
phrase is a pair of the ids of its first and its last k words, so equal ids mean equal phrases. A
block's counts go to owners by a hash of the phrase, one packed list for each owner, and owners answer
with the frequent ones; a block's occurrences meet those by block. So a word or phrase with a third
of all occurrences is one entry of each block, and nothing is broadcast or gathered.

Words: A-Z is lower-cased, texts are cut at ``[.,;:!?\\x0A-\\x0D]`` into pieces and these at blanks and
tabs. All counts are per ``lang`` (NULL: ``und``). NULL and empty texts have no words; repeated rows
count as often as they come; doc_id and other columns are not looked at. Equal scores are ordered by
count, then phrase in byte order. An empty table gives no rows. A block holds whole documents, so a
very long text makes a block of its own length.
"""

from __future__ import annotations

from collections import defaultdict
from collections.abc import Iterator
from itertools import count

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import zstandard
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window, functions as F

from flowlake.llm.common import UPPER, mix64, power_of_two, written
from flowlake.operators.joins import lookup_join
from flowlake.session import work_dir
from flowlake.sinks import folders

LEAST = 100
LONGEST = 5
PER_LANG = 2000
BLOCK_WORDS = 2_000_000
# Words and pairs of blocks that one owner counts, on average.
OWNER_WORDS = 500_000
OWNER_PAIRS = 2_000_000

# A byte that no text in UTF-8 holds stands for the end of a piece.
_END = b"\xff"
_RULES = bytes(range(256)).translate(
    bytes.maketrans(UPPER.encode() + b"\t.,;:!?\n\x0b\x0c\r", UPPER.lower().encode() + b" " + _END * 10)
)

# A block's relation (``gaps`` is set), one of its words (number ``i``), or its words of a language.
_WORDS = "block long, n long, gaps binary, phrases binary, i int, lang string, word binary, c long"
_RELATION = "block long, n long, gaps binary, phrases binary, ids binary"
_SENT = "owner long, block long, heads binary, tails binary, counts binary"
# What owners find: a frequent phrase (``f`` is set), or an answer to a block.
_WORD_ANSWER = "id long, f long, lang string, word binary, block long, numbers binary, ids binary"
_PAIR_ANSWER = "id long, f long, head long, tail long, block long, heads binary, tails binary, ids binary"
_TYPES = {"long": pa.int64(), "int": pa.int32(), "binary": pa.binary(), "string": pa.string()}


def _schema(fields: str) -> pa.Schema:
    return pa.schema([(name, _TYPES[kind]) for name, kind in (f.split() for f in fields.split(", "))])


def _rows(fields: str, size: int, **columns) -> pa.RecordBatch:
    """``size`` rows; columns that are not given are NULL, single numbers are repeated."""
    schema = _schema(fields)
    arrays = []
    for field in schema:
        value = columns.get(field.name)
        if isinstance(value, int):
            value = np.full(size, value)
        arrays.append(pa.nulls(size, field.type) if value is None else pa.array(value, field.type))
    return pa.RecordBatch.from_arrays(arrays, schema=schema)


def _packed(values: np.ndarray, kind: str = "<i8") -> bytes:
    return zstandard.ZstdCompressor(level=1).compress(values.astype(kind).tobytes())


def _unpacked(data: bytes, kind: str = "<i8") -> np.ndarray:
    return np.frombuffer(zstandard.ZstdDecompressor().decompress(data), kind)


def _packed_sorted(values: np.ndarray, kind: str = "<i8") -> bytes:
    return _packed(np.diff(values, prepend=0), kind)


def _unpacked_sorted(data: bytes, kind: str = "<i8") -> np.ndarray:
    return np.cumsum(_unpacked(data, kind), dtype=np.int64)


def _by_key(keys: np.ndarray) -> tuple[np.ndarray, list[np.ndarray]]:
    """(distinct keys ascending, the places of each in order)."""
    order = np.argsort(keys, kind="stable")
    distinct, begin = np.unique(keys[order], return_index=True)
    return distinct, np.split(order, begin[1:]) if len(distinct) else []


class Block:
    """The words of some documents: numbers by language and word, in the order of their places."""

    def __init__(self):
        number = count(1)
        self.numbers: dict[str, dict[bytes, int]] = defaultdict(lambda: defaultdict(number.__next__, {_END: 0}))
        self.parts: list[np.ndarray] = []
        self.size = 0

    def add(self, lang: str, text: bytes) -> None:
        tokens = text.translate(_RULES).replace(_END, b" \xff ").split()
        tokens.append(_END)
        self.parts.append(np.fromiter(map(self.numbers[lang].__getitem__, tokens), np.int32, len(tokens)))
        self.size += len(tokens)

    def rows(self, block: int) -> Iterator[pa.RecordBatch]:
        numbers = np.concatenate(self.parts)
        places = np.flatnonzero(numbers)
        if not len(places):
            return
        phrases = numbers[places]
        yield _rows(
            _WORDS, 1, block=block, n=len(places), gaps=[_packed_sorted(places, "<i4")], phrases=[_packed(phrases, "<i4")]
        )
        counts = np.bincount(phrases)
        for lang, words in self.numbers.items():
            del words[_END]
            if words:
                i = np.fromiter(words.values(), np.int32, len(words))
                yield _rows(_WORDS, len(i), block=block, i=i, lang=[lang] * len(i), word=list(words), c=counts[i])
                yield _rows(_WORDS, 1, block=block, lang=[lang], c=int(counts[i].sum()))


def word_relation(docs: DataFrame, block_words: int = BLOCK_WORDS) -> DataFrame:
    """The blocks' word relations and word counts."""

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        number, block = TaskContext.get().partitionId() << 32, Block()
        for batch in batches:
            for at in range(0, batch.num_rows, 256):
                part = batch.slice(at, 256)
                for lang, text in zip(part.column(0).to_pylist(), part.column(1).to_pylist()):
                    block.add(lang, text)
                    if block.size >= block_words:
                        yield from block.rows(number)
                        number, block = number + 1, Block()
        if block.size:
            yield from block.rows(number)

    texts = docs.select(
        F.coalesce(docs["lang"], F.lit("und")).alias("lang"),
        F.coalesce(docs["text"], F.lit("")).cast("binary").alias("text"),
    )
    return texts.mapInArrow(read, _WORDS)


def _frequent_words(least: int):
    def find(sent: pa.Table) -> pa.Table:
        """An owner's frequent words, and where each block has them."""
        total = sent.group_by(["lang", "word"]).aggregate([("c", "sum")])
        total = total.filter(pc.greater_equal(total["c_sum"], least)).sort_by([("lang", "ascending"), ("word", "ascending")])
        if not total.num_rows:
            return _schema(_WORD_ANSWER).empty_table()
        ids = (sent["owner"][0].as_py() << 32) + np.arange(total.num_rows)
        total = total.append_column("id", pa.array(ids))
        found = sent.select(["lang", "word", "block", "i"]).join(total.select(["lang", "word", "id"]), ["lang", "word"], join_type="inner")
        block, i, answer = (found[c].to_numpy() for c in ("block", "i", "id"))
        met, lists = _by_key(block)
        return pa.Table.from_batches([
            _rows(_WORD_ANSWER, total.num_rows, id=ids, f=total["c_sum"].to_numpy(), lang=total["lang"].to_pylist(), word=total["word"].to_pylist()),
            _rows(
                _WORD_ANSWER, len(met), block=met, numbers=[_packed(i[p], "<i4") for p in lists],
                ids=[_packed(answer[p]) for p in lists],
            ),
        ])

    return find


def _keep_words(relation: pa.Table, frequent: pa.Table) -> pa.Table:
    """A block's relation of its frequent words."""
    if not relation.num_rows or not frequent.num_rows:
        return _schema(_RELATION).empty_table()
    phrases = _unpacked(relation["phrases"][0].as_py(), "<i4")
    i = np.concatenate([_unpacked(n, "<i4") for n in frequent["numbers"].to_pylist()])
    answer = np.concatenate([_unpacked(a) for a in frequent["ids"].to_pylist()])
    ids = np.sort(answer)
    new = np.full(int(max(phrases.max(), i.max())) + 1, -1, np.int64)
    new[i] = np.searchsorted(ids, answer)
    phrases = new[phrases]
    kept = phrases >= 0
    places = _unpacked_sorted(relation["gaps"][0].as_py(), "<i4")[kept]
    return _relation(relation["block"][0].as_py(), places, phrases[kept], ids)


def _relation(block: int, places: np.ndarray, phrases: np.ndarray, ids: np.ndarray) -> pa.Table:
    """One row: places and the phrases there, as numbers into the ascending ``ids``."""
    return pa.Table.from_batches([_rows(
        _RELATION, 1, block=block, n=len(places), gaps=[_packed_sorted(places, "<i4")],
        phrases=[_packed(phrases, "<i4")], ids=[_packed_sorted(ids)],
    )])


def _open(row: dict) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(places, numbers, ids) of a relation's row."""
    return _unpacked_sorted(row["gaps"], "<i4"), _unpacked(row["phrases"], "<i4"), _unpacked_sorted(row["ids"])


def merge_adjacent(places: np.ndarray, phrases: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """A sorted relation joined with itself on adjacent places: (places, pairs (first << 32 | second))."""
    adjacent = np.flatnonzero(places[1:] == places[:-1] + 1)
    return places[adjacent], phrases[adjacent].astype(np.int64) << 32 | phrases[adjacent + 1]


def _count_pairs(owner_bits: int):
    def send(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for row in batch.to_pylist():
                places, phrases, ids = _open(row)
                distinct, counts = np.unique(merge_adjacent(places, phrases)[1], return_counts=True)
                heads, tails = ids[distinct >> 32], ids[distinct & 0xFFFFFFFF]
                with np.errstate(over="ignore"):
                    mixed = mix64(mix64(heads.view(np.uint64)) + tails.view(np.uint64))
                owner = (mixed & np.uint64((1 << owner_bits) - 1)).astype(np.int64)
                owners, parts = _by_key(owner)
                yield _rows(
                    _SENT, len(owners), owner=owners, block=row["block"],
                    heads=[_packed_sorted(heads[p]) for p in parts], tails=[_packed(tails[p]) for p in parts],
                    counts=[_packed(counts[p], "<i4") for p in parts],
                )

    return send


def _frequent_pairs(least: int):
    def find(sent: pa.Table) -> pa.Table:
        """An owner's frequent pairs, and those of each block."""
        sent = sent.sort_by("block")
        blocks = sent["block"].to_numpy()
        heads = [_unpacked_sorted(h) for h in sent["heads"].to_pylist()]
        part = np.repeat(np.arange(len(blocks)), [len(h) for h in heads])
        heads = np.concatenate(heads)
        tails = np.concatenate([_unpacked(t) for t in sent["tails"].to_pylist()])
        counts = np.concatenate([_unpacked(c, "<i4") for c in sent["counts"].to_pylist()])
        order = np.lexsort((tails, heads))
        heads, tails, part = heads[order], tails[order], part[order]
        first = np.flatnonzero(np.concatenate(([True], (heads[1:] != heads[:-1]) | (tails[1:] != tails[:-1]))))
        total = np.add.reduceat(counts[order].astype(np.int64), first)
        group = np.repeat(np.arange(len(first)), np.diff(np.append(first, len(heads))))
        often = total >= least
        ids = np.full(len(first), -1, np.int64)
        ids[often] = (sent["owner"][0].as_py() << 32) + np.arange(int(often.sum()))
        tables = [_rows(_PAIR_ANSWER, int(often.sum()), id=ids[often], f=total[often], head=heads[first][often], tail=tails[first][often])]
        kept = ids[group] >= 0
        heads, tails, part, answer = heads[kept], tails[kept], part[kept], ids[group][kept]
        met, lists = _by_key(part)
        tables.append(_rows(
            _PAIR_ANSWER, len(met), block=blocks[met], heads=[_packed_sorted(heads[p]) for p in lists],
            tails=[_packed(tails[p]) for p in lists], ids=[_packed(answer[p]) for p in lists],
        ))
        return pa.Table.from_batches(tables)

    return find


def _keep_pairs(relation: pa.Table, frequent: pa.Table) -> pa.Table:
    """A block's relation merged with itself, without the rare pairs."""
    if not relation.num_rows or not frequent.num_rows:
        return _schema(_RELATION).empty_table()
    row = relation.to_pylist()[0]
    places, phrases, ids = _open(row)
    heads = np.concatenate([_unpacked_sorted(h) for h in frequent["heads"].to_pylist()])
    tails, new = (np.concatenate([_unpacked(t) for t in frequent[c].to_pylist()]) for c in ("tails", "ids"))
    pairs = np.searchsorted(ids, heads) << 32 | np.searchsorted(ids, tails)
    order = np.argsort(pairs)
    pairs, new = pairs[order], new[order]
    places, joined = merge_adjacent(places, phrases)
    at = np.minimum(np.searchsorted(pairs, joined), len(pairs) - 1)
    kept = pairs[at] == joined
    ids = np.sort(new)
    return _relation(row["block"], places[kept], np.searchsorted(ids, new[at[kept]]), ids)


def _owner_bits(rows: int, each: int) -> int:
    return power_of_two(rows / each)


class _Relation:
    """The relation of one level, written; it is removed when the next one is."""

    def __init__(self, rows: DataFrame):
        self.spark, self.path = rows.sparkSession, work_dir(rows.sparkSession, "phrase-relation")
        rows.write.parquet(self.path)
        self.rows = self.spark.read.schema(rows.schema).parquet(self.path)

    def size(self) -> int:
        return self.rows.agg(F.coalesce(F.sum("n"), F.lit(0))).first()[0]

    def narrowed(self, keep, answers: DataFrame) -> _Relation:
        own = answers.filter("f IS NULL").withColumnRenamed("block", "of").drop("f")
        pairs = self.rows.filter("gaps IS NOT NULL").groupBy("block").cogroup(own.groupBy("of"))
        made = _Relation(pairs.applyInArrow(keep, _RELATION))
        folders.remove(self.spark, self.path)
        return made


def mine(docs: DataFrame, least: int = LEAST, longest: int = LONGEST, block_words: int = BLOCK_WORDS) -> list[DataFrame]:
    """For each length from 1 word on, the phrases with at least ``least`` occurrences:
    id, lang, n (all words of the language), phrase, last (word), f, heads (counts of its proper
    beginnings, by length), tails (counts of what is left of it behind each of them), and from 2
    words on head and tail, the ids of the phrase without its last and without its first word."""
    level = _Relation(word_relation(docs, block_words))
    sizes = written(
        level.rows.filter("i IS NULL AND lang IS NOT NULL").groupBy("lang").agg(F.sum("c").alias("n")), "phrase-languages"
    )
    words = level.rows.filter("i IS NOT NULL")
    owners = 1 << _owner_bits(words.count(), OWNER_WORDS)
    sent = words.select(F.pmod(F.xxhash64("lang", "word"), F.lit(owners)).alias("owner"), "block", "i", "lang", "word", "c")
    answers = written(sent.groupBy("owner").applyInArrow(_frequent_words(least), _WORD_ANSWER), "phrase-answers")
    word, none = F.col("word").cast("string"), F.array().cast("array<long>")
    frequent = lookup_join(answers.filter("f IS NOT NULL").select("id", "f", "lang", "word"), sizes, "lang", ["id"], how="inner")
    found = [written(frequent.select(
        "id", "lang", "n", word.alias("phrase"), word.alias("last"), "f", none.alias("heads"), none.alias("tails")
    ), "phrases")]
    level = level.narrowed(_keep_words, answers)
    for length in range(2, longest + 1):
        sent = level.rows.mapInArrow(_count_pairs(_owner_bits(level.size(), OWNER_PAIRS)), _SENT)
        answers = written(sent.groupBy("owner").applyInArrow(_frequent_pairs(least), _PAIR_ANSWER), "phrase-answers")
        head = found[-1].select(
            F.col("id").alias("head"), "lang", "n", "phrase", F.array_append("heads", F.col("f")).alias("heads")
        )
        tail = found[-1].select(F.col("id").alias("tail"), "last", F.array_prepend("tails", F.col("f")).alias("tails"))
        pairs = answers.filter("f IS NOT NULL").select("id", "f", "head", "tail")
        phrases = pairs.join(head, "head").join(tail, "tail").withColumn("phrase", F.concat_ws(" ", "phrase", "last"))
        found.append(written(phrases, "phrases"))
        if length < longest:
            level = level.narrowed(_keep_pairs, answers)
    folders.remove(level.spark, level.path)
    return found


def at_least_cut(phrases: DataFrame) -> DataFrame:
    """Phrases (lang, n, phrase, a, heads, tails) with score, l and r of the cut that scores least."""
    # Products of up to 38 digits; the quotient is exact and cut, not rounded.
    cut = F.expr("""array_min(transform(sequence(0, size(heads) - 1), k -> struct(
        (CAST(1000 AS DECIMAL(4, 0)) * CAST(a AS DECIMAL(17, 0)) * CAST(n AS DECIMAL(17, 0)))
            div (CAST(heads[k] AS DECIMAL(19, 0)) * CAST(tails[k] AS DECIMAL(19, 0))) AS score,
        k AS k, heads[k] AS l, tails[k] AS r)))""")
    return phrases.withColumn("cut", cut).select("lang", "phrase", "a", "cut.l", "cut.r", "n", "cut.score")


def collocations(
    docs: DataFrame, least: int = LEAST, longest: int = LONGEST, per_lang: int = PER_LANG,
    block_words: int = BLOCK_WORDS,
) -> DataFrame:
    """The ``per_lang`` best phrases of 2 to ``longest`` words of each language: lang, rank, phrase,
    a, l, r, n, score.

    A phrase's score is floor(1000 * a * n / (l * r)) at the cut into two parts where it is least, the
    first such cut. A phrase goes that lies inside a longer one with as many occurrences. It is
    enough to look one word further: counts never rise as a phrase grows.
    """
    found = mine(docs, least, longest, block_words)
    kept = []
    for shorter, longer in zip(found[1:], [*found[2:], None]):
        if longer is not None:
            inside = longer.filter(F.col("f") == F.element_at("heads", -1)).select(F.col("head").alias("id"))
            behind = longer.filter(F.col("f") == F.element_at("tails", 1)).select(F.col("tail").alias("id"))
            shorter = shorter.join(inside.unionByName(behind).distinct(), "id", "left_anti")
        kept.append(shorter.select("lang", "n", "phrase", F.col("f").alias("a"), "heads", "tails"))
    phrases = kept[0]
    for more in kept[1:]:
        phrases = phrases.unionByName(more)
    scored = at_least_cut(phrases)
    order = Window.partitionBy("lang").orderBy(F.desc("score"), F.desc("a"), "phrase")
    ranked = scored.withColumn("rank", F.row_number().over(order)).filter(F.col("rank") <= per_lang)
    return ranked.select("lang", F.col("rank").cast("long").alias("rank"), "phrase", "a", "l", "r", "n", "score")
