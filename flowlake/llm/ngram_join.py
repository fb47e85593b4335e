"""N-gram Jaccard join with adaptive multi-match prefixes.

Words ``[^\\x20\\x09-\\x0D]+`` with A-Z lower-cased; a document's set are its distinct five-word
shingles (with fewer words, the whole sequence). Two documents link when
100 * |intersection| >= 80 * |union|; the result are connected components of these links.

1. Each task sends its chunks' shingle hashes to the owners of the hash ranges, packed in arrays.
   Owners count documents per shingle and send back only shingles that two documents share.
2. A document's shingles are ordered rare first. Any partner shares at least o = ceil(0.8 * n) of
   them, so a document with fewer shared ones than o is done: it has no partner.
3. Of the others, the prefix of length n - o + l must share at least l shingles with a partner's
   (l the smaller of both). Each document picks the l of least estimated cost: postings to read
   plus candidates to verify, which fall as l grows.
4. Equal sets are one class. Each class is first compared with one hub, of the classes at the head
   of its prefix shingles' postings the one it shares most of them with, so a large group of near
   copies takes as many comparisons as it has members.
5. Classes of different hubs are paired by their prefixes, counted against l, and verified on
   whole sets. Classes x and y of one hub h share at least R = 80/180 * (|x| + |y|) shingles if they
   link, and at most min(|x & h|, |y & h|) of them lie in h. Where that is less than R, they share one
   outside of h, and are paired by those few; the others are paired by size. So the members of a
   group that all differ from its middle in their own way are not compared with each other.
   Classes that are linked already are left out; no link between components is.

Empty or NULL texts have no set and link with nothing. A NULL doc_id takes part, but is not the
smallest of a component unless there is no other. Repeated rows give repeated results. An empty
table gives no rows; other columns are not looked at.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame, functions as F

from flowlake.llm.common import SPACE_WORD, mix64, parts_of, power_of_two, sequence_hashes, word_hashes, written
from flowlake.llm.components import components

WORDS = 5
PERCENT = 80
CHUNK_WORDS = 1_000_000
CHUNK_DOCS = 60_000
OWNER_POSTINGS = 500_000
MOST_MATCHES = 8
VERIFY_COST = 4.0

_PACKED = "owner long, chunk long, low binary, high binary, doc binary, df binary, ids array<long>, t array<long>, k1 array<long>, k2 array<long>, n array<long>, first array<long>"
_FIELDS = [f.split()[0] for f in _PACKED.split(", ")]


def _arrow(schema: str) -> pa.Schema:
    kinds = {"long": pa.int64(), "binary": pa.binary(), "array<long>": pa.list_(pa.int64()), "int": pa.int32()}
    return pa.schema([(f.split()[0], kinds[f.split()[1]]) for f in schema.split(", ")])


def least_overlap(n: np.ndarray | int):
    """Shingles that a set of ``n`` has in common with any set it links with, at least."""
    return -(-PERCENT * n // 100)


def _key(words: np.ndarray) -> tuple[int, int]:
    """128 bits of a word sequence, position by position."""
    place = mix64(np.arange(1, len(words) + 1, dtype=np.uint64))
    with np.errstate(over="ignore"):
        a = mix64(words ^ place).sum(dtype=np.uint64)
        b = mix64(words * np.uint64(0x9E3779B97F4A7C15) + place).sum(dtype=np.uint64)
    return int(a.view(np.int64)), int(b.view(np.int64))


def _sender(owner_bits: int):
    low_bits = min(48, 64 - owner_bits)

    def pack(chunk: int, held: list) -> Iterator[dict]:
        """A header with the chunk's documents, and its postings by owner."""
        seen: dict[tuple[int, int, int], int] = {}
        parts, docs = [], []
        ids, ts, k1, k2, ns, first = [], [], [], [], [], []
        for at, (doc_id, t, words) in enumerate(held):
            shingles = np.unique(sequence_hashes(words, WORDS))
            key = (*_key(words), len(words))
            ids.append(doc_id), ts.append(t), k1.append(key[0]), k2.append(key[1]), ns.append(len(shingles))
            first.append(seen.setdefault(key, at))
            if first[-1] == at and len(shingles):
                parts.append(np.unique(shingles >> np.uint64(64 - owner_bits - low_bits)))
                docs.append(np.full(len(parts[-1]), at, np.uint16))
        yield dict(owner=chunk % (1 << owner_bits), chunk=chunk, ids=ids, t=ts, k1=k1, k2=k2, n=ns, first=first)
        if not parts:
            return
        tokens, docs = np.concatenate(parts), np.concatenate(docs)
        order = np.argsort(tokens, kind="stable")
        tokens, docs = tokens[order], docs[order]
        owners = (tokens >> np.uint64(low_bits)).astype(np.int64)
        found, begin = np.unique(owners, return_index=True)
        for owner, a, b in zip(found.tolist(), begin, [*begin[1:], len(tokens)]):
            low = tokens[a:b]
            yield dict(
                owner=owner, chunk=chunk, low=low.astype(np.uint32).tobytes(),
                high=(low >> np.uint64(32)).astype(np.uint16).tobytes(), doc=docs[a:b].tobytes(),
            )

    def send(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        schema, held, words, chunk = _arrow(_PACKED), [], 0, TaskContext.get().partitionId() << 32

        def flush():
            rows = list(pack(chunk, held))
            for at in range(0, len(rows), 64):
                yield pa.RecordBatch.from_pylist(rows[at : at + 64], schema)

        for batch in batches:
            for doc_id, text, t in zip(batch.column(0).to_pylist(), batch.column(1), batch.column(2).to_pylist()):
                hashed = word_hashes(text.as_py() or "")
                held.append((doc_id, t, hashed))
                words += len(hashed)
                if words >= CHUNK_WORDS or len(held) >= CHUNK_DOCS:
                    yield from flush()
                    held, words, chunk = [], 0, chunk + 1
        if held:
            yield from flush()

    return send


def _tokens(row: dict, low_bits: int) -> np.ndarray:
    """Tokens of one packed row; the upper 16 of the 48 kept bits may hold some of the owner's."""
    low = np.frombuffer(row["low"], np.uint32).astype(np.uint64)
    low |= np.frombuffer(row["high"], np.uint16).astype(np.uint64) << np.uint64(32)
    low &= np.uint64((1 << low_bits) - 1)
    return low | np.uint64(row["owner"] << low_bits)


def _owner(owner_bits: int):
    low_bits = min(48, 64 - owner_bits)

    def share(table: pa.Table) -> pa.Table:
        """Headers as they are, and of each chunk the postings that another document shares."""
        rows = table.to_pylist()
        out = [r for r in rows if r["ids"] is not None]
        sent = [r for r in rows if r["ids"] is None]
        if sent:
            tokens = [_tokens(r, low_bits) for r in sent]
            _, at, counts = np.unique(np.concatenate(tokens), return_inverse=True, return_counts=True)
            df = counts[at]
            ends = np.cumsum([len(t) for t in tokens])
            for r, part in zip(sent, np.split(df, ends[:-1])):
                keep = part > 1
                if keep.any():
                    out.append(dict(
                        owner=r["owner"], chunk=r["chunk"],
                        low=np.frombuffer(r["low"], np.uint32)[keep].tobytes(),
                        high=np.frombuffer(r["high"], np.uint16)[keep].tobytes(),
                        doc=np.frombuffer(r["doc"], np.uint16)[keep].tobytes(),
                        df=part[keep].astype(np.uint32).tobytes(),
                    ))
        return pa.Table.from_pylist(out, _arrow(_PACKED))

    return share


def matches_needed(df: np.ndarray, n: int) -> int:
    """The number of shared prefix shingles of least estimated cost, for shared shingles of
    ascending document counts ``df`` in a set of ``n``."""
    base = len(df) - least_overlap(n)
    most = min(MOST_MATCHES, least_overlap(n))
    postings = np.cumsum(df - 1.0)[base : base + most]
    tries = np.arange(1, len(postings) + 1)
    return int(np.argmin(postings + VERIFY_COST * n * postings / tries)) + 1


_SETS = "doc_id long, t long, k1 long, k2 long, n long, matches long, prefix array<long>, tokens binary, crowd long"


def _assembler(owner_bits: int):
    low_bits = min(48, 64 - owner_bits)

    def assemble(table: pa.Table) -> pa.Table:
        """One row per document; its ordered shared shingles where it may have a partner."""
        rows = table.to_pylist()
        head = next(r for r in rows if r["ids"] is not None)
        n, first = np.array(head["n"]), np.array(head["first"])
        tokens, prefix, matches, crowd = ([None] * len(n) for _ in range(4))
        sent = [r for r in rows if r["ids"] is None]
        if sent:
            token = np.concatenate([_tokens(r, low_bits) for r in sent])
            doc = np.concatenate([np.frombuffer(r["doc"], np.uint16) for r in sent])
            df = np.concatenate([np.frombuffer(r["df"], np.uint32) for r in sent])
            order = np.lexsort((token, df, doc))
            token, doc, df = token[order], doc[order], df[order]
            found, begin = np.unique(doc, return_index=True)
            for at, a, b in zip(found.tolist(), begin, [*begin[1:], len(doc)]):
                if b - a >= least_overlap(n[at]):
                    l = matches_needed(df[a:b], n[at])
                    tokens[at] = token[a:b].tobytes()
                    prefix[at] = token[a : a + (b - a) - least_overlap(n[at]) + l].view(np.int64)
                    matches[at], crowd[at] = l, int(df[a:b].sum())
        schema = _arrow(_SETS)
        columns = [head["ids"], head["t"], head["k1"], head["k2"], head["n"], matches, prefix, tokens, crowd]
        return pa.Table.from_arrays([pa.array(c, f.type) for c, f in zip(columns, schema)], schema=schema)

    return assemble


def _hash(docs: DataFrame) -> Column:
    return F.xxhash64(F.coalesce(docs["text"], F.lit("")))


def shared_sets(docs: DataFrame) -> DataFrame:
    """Written: every document with a hash ``t`` of its text, its set's size, and the shared shingles
    of those that may link."""
    rows = docs.select(docs["doc_id"].cast("long").alias("doc_id"), docs["text"].alias("text"), _hash(docs).alias("t"))
    size = rows.agg(F.sum(F.octet_length("text")).alias("bytes")).first().bytes or 0
    # Words take about eight bytes; the estimate only sets how many owners share the work.
    owner_bits = max(1, power_of_two(max(parts_of(docs.sparkSession), size / 8 / OWNER_POSTINGS)))
    sent = rows.mapInArrow(_sender(owner_bits), _PACKED)
    shared = sent.groupBy("owner").applyInArrow(_owner(owner_bits), _PACKED)
    return written(shared.groupBy("chunk").applyInArrow(_assembler(owner_bits), _SETS), "join-sets")


Expand = Callable[[list], list[np.ndarray]]


def hashes_of(packed: list[bytes]) -> list[np.ndarray]:
    """Sets from packed 64-bit hashes."""
    return [np.frombuffer(p, np.uint64) for p in packed]


def _compare(pairs: DataFrame, classes: DataFrame, expand: Expand) -> DataFrame:
    """(a, na, b, nb, both, outside) of pairs (a, b) of classes: sizes, common shingles, and the
    shingles of ``b`` outside of ``a``. ``expand`` makes sets of a column of ``tokens``."""
    sets = classes.select("cid", "n", "tokens")
    left = sets.select(F.col("cid").alias("a"), F.col("n").alias("na"), F.col("tokens").alias("ta"))
    right = sets.select(F.col("cid").alias("b"), F.col("n").alias("nb"), F.col("tokens").alias("tb"))

    def compare(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for whole in batches:
            for at in range(0, whole.num_rows, 256):
                batch, both, outside = whole.slice(at, 256), [], []
                sets = expand(batch.column("ta").to_pylist() + batch.column("tb").to_pylist())
                for x, y in zip(sets[: batch.num_rows], sets[batch.num_rows :]):
                    rest = np.setdiff1d(y, x, assume_unique=True)
                    both.append(len(y) - len(rest))
                    outside.append(rest.view(np.int64))
                columns = [batch.column(c) for c in ("a", "na", "b", "nb")]
                yield pa.RecordBatch.from_arrays(
                    [*columns, pa.array(both, pa.int64()), pa.array(outside, pa.list_(pa.int64()))],
                    names=["a", "na", "b", "nb", "both", "outside"],
                )

    joined = pairs.join(right, "b").join(left, "a").select("a", "na", "ta", "b", "nb", "tb")
    return joined.mapInArrow(compare, "a long, na long, b long, nb long, both long, outside array<long>")


LINKED = f"both * 100 >= (na + nb - both) * {PERCENT}"


def _hubs(postings: DataFrame) -> DataFrame:
    """(a, b): each class ``b`` of (token, cid, crowd) and the hub ``a`` it shares most tokens with.

    The hub of a token is the class with the most crowded shingles, which is near the middle of a
    group of near copies.
    """
    order = F.struct("crowd", "cid")
    hubs = postings.groupBy("token").agg(F.max(order)["cid"].alias("hub"), F.count("*").alias("c")).filter("c > 1")
    shared = postings.join(hubs, "token").filter("cid <> hub").groupBy("cid", "hub").agg(F.count("*").alias("shared"))
    return shared.groupBy("cid").agg(F.max(F.struct("shared", "hub"))["hub"].alias("a")).select("a", F.col("cid").alias("b"))


def _rooted(classes: DataFrame, edges: DataFrame) -> DataFrame:
    roots = components(edges).withColumnRenamed("node", "cid")
    return classes.join(roots, "cid", "left").withColumn("root", F.coalesce("root", "cid"))


def _near(na: str, nb: str):
    return (F.col(na) * 100 >= F.col(nb) * PERCENT) & (F.col(nb) * 100 >= F.col(na) * PERCENT)


def _side(rows: DataFrame, group: str, side: str) -> DataFrame:
    return rows.select("token", F.col(group).alias(f"g{side}"), F.col("cid").alias(side), F.col("root").alias(f"r{side}"),
                       F.col("n").alias(f"n{side}"), F.col("matches").alias(f"l{side}"))


def _between_hubs(classes: DataFrame) -> DataFrame:
    """Pairs of classes of different hubs and components with enough shared prefix shingles."""
    postings = classes.select("cid", "root", "hub", "n", "matches", F.explode("prefix").alias("token"))
    mixed = (
        postings.groupBy("token").agg(F.min("root").alias("r"), F.max("root").alias("s"), F.min("hub").alias("h"), F.max("hub").alias("i"))
        .filter("r <> s AND h <> i").select("token")
    )
    postings = written(postings.join(mixed, "token", "left_semi"), "join-postings")
    groups = postings.select("token", "hub").distinct()
    across = groups.withColumnRenamed("hub", "ga").join(groups.withColumnRenamed("hub", "gb"), "token").filter("ga < gb")
    return (
        across.join(_side(postings, "hub", "a"), ["token", "ga"]).join(_side(postings, "hub", "b"), ["token", "gb"])
        .filter((F.col("ra") != F.col("rb")) & _near("na", "nb"))
        .groupBy("a", "b", F.least("la", "lb").alias("l")).agg(F.count("*").alias("shared"))
        .filter("shared >= l").select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b"))
    )


def _outside(compared: DataFrame) -> DataFrame:
    """(token, cid) by hub and shingle outside of it."""
    rows = compared.select("a", F.col("b").alias("cid"), F.explode("outside").alias("shingle"))
    return rows.select(F.struct("a", "shingle").alias("token"), "cid")


def _within_hubs(classes: DataFrame, compared: DataFrame) -> DataFrame:
    """Pairs of classes of one hub and different components that share a shingle outside of it."""
    postings = _outside(compared).join(classes.select("cid", "root", "n", "matches"), "cid")
    mixed = postings.groupBy("token").agg(F.min("root").alias("r"), F.max("root").alias("s")).filter("r <> s").select("token")
    postings = written(postings.join(mixed, "token", "left_semi"), "join-outside")
    groups = postings.select("token", "root").distinct()
    across = groups.withColumnRenamed("root", "ga").join(groups.withColumnRenamed("root", "gb"), "token").filter("ga < gb")
    return (
        across.join(_side(postings, "root", "a"), ["token", "ga"]).join(_side(postings, "root", "b"), ["token", "gb"])
        .filter(_near("na", "nb")).select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b")).distinct()
    )


def _by_size(classes: DataFrame, compared: DataFrame) -> DataFrame:
    """Pairs of classes of one hub and different components whose common shingles may all lie in it."""
    # R <= both of either, as a limit to the other's size.
    limit = F.floor(F.col("both") * (100 + PERCENT) / PERCENT).cast("long") - F.col("nb")
    rows = written(
        compared.select(F.col("a").alias("hub"), F.col("b").alias("cid"), F.col("nb").alias("n"), limit.alias("limit"), F.expr(LINKED).alias("linked"))
        .join(classes.select("cid", "root"), "cid"),
        "join-limits",
    )
    sizes = rows.select("hub", "n").distinct()
    alone = rows.filter("NOT linked").select("hub", F.col("cid").alias("x"), F.col("root").alias("rx"), F.col("n").alias("nx"), F.col("limit").alias("lx"))
    reach = alone.join(sizes, "hub").filter((F.col("n") <= F.col("lx")) & _near("n", "nx"))
    pairs = reach.join(rows, ["hub", "n"]).filter("x <> cid AND rx <> root AND nx <= limit")
    return pairs.select(F.least("x", "cid").alias("a"), F.greatest("x", "cid").alias("b")).distinct()


def link_classes(classes: DataFrame, expand: Expand) -> DataFrame:
    """Links (a, b) whose components are those of all similar pairs of classes that share enough of
    their prefixes. ``classes``: cid, n (size of the set), tokens, prefix, matches, crowd."""
    lists = classes.select("cid", "crowd", F.explode("prefix").alias("token"))
    first = written(_compare(_hubs(lists), classes, expand), "join-hubs")
    crowd = classes.select("cid", "crowd")
    second = written(_compare(_hubs(_outside(first).join(crowd, "cid")), classes, expand).filter(LINKED).select("a", "b"), "join-links")
    links = first.filter(LINKED).select("a", "b").unionByName(second)
    hub = first.select(F.col("b").alias("cid"), F.col("a").alias("hub"))
    rooted = _rooted(classes.select("cid", "n", "matches", "prefix"), links).join(hub, "cid", "left")
    rooted = written(rooted.withColumn("hub", F.coalesce("hub", "cid")), "join-rooted")
    pairs = _between_hubs(rooted).unionByName(_within_hubs(rooted, first)).unionByName(_by_size(rooted, first)).distinct()
    more = written(_compare(pairs, classes, expand).filter(LINKED).select("a", "b"), "join-links")
    return links.unionByName(more)


def _named(docs: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(sets, classes): every document, and for each class (k1, k2, n) of equal sets its component and
    the first (absent, doc_id, t) of its documents."""
    sets = shared_sets(docs)
    classes = written(
        sets.filter("tokens IS NOT NULL").groupBy("k1", "k2", "n")
        .agg(*[F.first(c).alias(c) for c in ("matches", "prefix", "tokens", "crowd")])
        .withColumn("cid", F.monotonically_increasing_id()),
        "join-classes",
    )
    linked = _rooted(classes.select("cid", "k1", "k2", "n"), link_classes(classes, hashes_of))
    # A class is named by its key; classes with no partner are their own component.
    document = F.struct(F.col("doc_id").isNull().alias("absent"), "doc_id", "t")
    smallest = sets.filter("n > 0").groupBy("k1", "k2", "n").agg(F.min(document).alias("least"))
    rows = smallest.join(linked.select("k1", "k2", "n", "root"), ["k1", "k2", "n"], "left")
    own = F.struct(F.coalesce("root", F.lit(-1)).alias("root"), F.when(F.col("root").isNull(), F.col("k1")).alias("k1"), F.when(F.col("root").isNull(), F.col("k2")).alias("k2"))
    return sets, rows.withColumn("component", own)


def similarity_components(docs: DataFrame) -> DataFrame:
    """doc_id, n_shingles, component_id of every row."""
    sets, named = _named(docs)
    lowest = named.groupBy("component").agg(F.min("least")["doc_id"].alias("component_id"))
    names = named.join(lowest, "component").select("k1", "k2", "n", "component_id")
    return sets.select("doc_id", "k1", "k2", "n").join(names, ["k1", "k2", "n"], "left").select(
        "doc_id", F.col("n").alias("n_shingles"),
        F.when(F.col("n") > 0, F.col("component_id")).otherwise(F.col("doc_id")).alias("component_id"),
    )


def one_of_each(docs: DataFrame) -> DataFrame:
    """One row of ``docs`` of each component, that with the smallest doc_id, with all its columns.

    A NULL doc_id comes last. Of rows with one doc_id the smallest hash of the text decides, of
    those with the same text too the other columns. Rows without words link with nothing and stay.
    """
    _, named = _named(docs)
    stay = named.groupBy("component").agg(F.min("least").alias("least"))
    # A struct is never NULL, so rows without a doc_id meet theirs.
    stay = stay.select(F.struct("least.doc_id").alias("_doc"), F.col("least.t").alias("_t"))
    has_words = F.coalesce(docs["text"].rlike(SPACE_WORD), F.lit(False))
    rows = docs.filter(has_words).select(
        F.struct(docs["doc_id"].cast("long").alias("doc_id")).alias("_doc"), _hash(docs).alias("_t"),
        F.struct(*[docs[c] for c in docs.columns]).alias("_row"),
    )
    kept = rows.join(stay, ["_doc", "_t"]).groupBy("_doc", "_t").agg(F.min("_row").alias("_row"))
    return kept.select("_row.*").unionByName(docs.filter(~has_words))
