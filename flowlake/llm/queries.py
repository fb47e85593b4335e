"""One query for each operator, over its whole table, and the SQL to compare it with where SQL can say it."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession, functions as F

from flowlake.llm import (
    ann, bestfit, chat, collocations, exact_dedup, licenses, lines, mixing, ngram_join, packing, quality, url_filter,
    whitening,
)
from flowlake.llm.common import reach_workers

Query = Callable[[SparkSession, str], DataFrame]

QUERIES: dict[str, Query] = {}
ORACLES: dict[str, str] = {}


def query(sql: str | None = None) -> Callable[[Query], Query]:
    def register(made: Query) -> Query:
        def run(spark: SparkSession, sf_dir: str) -> DataFrame:
            return made(reach_workers(spark), sf_dir)

        QUERIES[made.__name__] = run
        if sql is not None:
            ORACLES[made.__name__] = sql
        return run

    return register


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


LOWER = "translate({}, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"


@query()
def op1_ann(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The five nearest vectors of every fiftieth."""
    return ann.nearest(table(spark, sf_dir, "embeddings"), F.col("id") % 50 == 0, k=5)


@query()
def op2_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All documents, mixed by source with weights 1, 2, 3."""
    return mixing.mix(table(spark, sf_dir, "documents"))


@query()
def op3_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All documents, scored for quality."""
    return quality.classify(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


@query()
def op4_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All documents, packed into sequences of 2048 ids."""
    return packing.digest(packing.pack(table(spark, sf_dir, "documents")))


@query(f"""
    WITH t AS (SELECT doc_id, {LOWER.format("COALESCE(text, '')")} AS text FROM documents)
    SELECT doc_id, MAX(doc_id) OVER w AS keep_id, COUNT(*) OVER w AS group_size,
           doc_id = MAX(doc_id) OVER w AS kept, SHA256(text) AS text_sha256
    FROM t WINDOW w AS (PARTITION BY text)
""")
def op5_exact_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All documents with the row that stays of each group of equal texts."""
    return exact_dedup.exact_dedup(table(spark, sf_dir, "documents"))


@query(f"""
    WITH c AS (
        SELECT conv_id, COALESCE(turn, -1) AS turn,
               COALESCE('r' || role, 'n') || chr(1) || COALESCE('t' || text, 'n') AS row,
               '<|im_start|>' || COALESCE(role, 'unknown') || chr(10) || COALESCE(text, '') || '<|im_end|>' || chr(10) AS line
        FROM conversations
    ),
    p AS (
        SELECT conv_id, turn, SHA256(STRING_AGG(turn || chr(2) || row, chr(3)) OVER (PARTITION BY conv_id ORDER BY turn, row)) AS prefix,
               COUNT(*) OVER (PARTITION BY conv_id ORDER BY turn, row) AS n, COUNT(*) OVER (PARTITION BY conv_id) AS n_turns
        FROM c
    ),
    w AS (SELECT prefix, n_turns, MIN(conv_id) AS conv_id, COUNT(*) AS n_equal FROM p WHERE n = n_turns GROUP BY ALL),
    k AS (SELECT * FROM w WHERE prefix NOT IN (SELECT prefix FROM p WHERE n < n_turns)),
    o AS (SELECT *, (row_number() OVER (PARTITION BY conv_id ORDER BY turn, row) - 1) // {chat.RUN} AS part FROM c)
    SELECT conv_id, part, n_turns, n_equal, STRING_AGG(line, '' ORDER BY turn, row) AS rendered
    FROM o JOIN k USING (conv_id) GROUP BY conv_id, part, n_turns, n_equal
""")
def op6_chat(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All conversations that no longer one begins with, rendered."""
    return chat.render(table(spark, sf_dir, "conversations"))


@query()
def op7_licenses(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All documents with the licence phrases in them."""
    return licenses.scan(table(spark, sf_dir, "documents"))


@query(f"""
    WITH d AS (SELECT doc_id, {LOWER.format("COALESCE(text, '')")} AS text FROM documents),
    w AS (
        SELECT doc_id, words, len(words) AS size, unnest(words) AS word, generate_subscripts(words, 1) AS i
        FROM (SELECT doc_id, regexp_extract_all(text, '[^\\x20\\x09-\\x0D]+') AS words FROM d)
    ),
    g5 AS (
        SELECT doc_id, size, i, CASE WHEN size < 5 THEN array_to_string(words, ' ') ELSE concat_ws(' ', word, LEAD(word, 1) OVER o,
            LEAD(word, 2) OVER o, LEAD(word, 3) OVER o, LEAD(word, 4) OVER o) END AS shingle
        FROM w WINDOW o AS (PARTITION BY doc_id ORDER BY i)
    ),
    e AS (SELECT DISTINCT doc_id, shingle FROM g5 WHERE i <= greatest(1, size - 4)),
    c AS (SELECT doc_id, COUNT(*) AS n FROM e GROUP BY doc_id),
    n AS (SELECT doc_id, COALESCE(c.n, 0) AS n FROM d LEFT JOIN c USING (doc_id)),
    h AS (SELECT shingle FROM e GROUP BY shingle HAVING COUNT(*) > 1),
    f AS (SELECT doc_id, shingle FROM e SEMI JOIN h USING (shingle)),
    m AS (SELECT doc_id FROM f JOIN n USING (doc_id) GROUP BY doc_id, n HAVING COUNT(*) * 100 >= n * 80),
    g AS (SELECT f.* FROM f SEMI JOIN m USING (doc_id)),
    l AS (
        SELECT a.doc_id AS x, b.doc_id AS y FROM g a JOIN g b ON a.shingle = b.shingle AND a.doc_id < b.doc_id
        JOIN n na ON na.doc_id = a.doc_id JOIN n nb ON nb.doc_id = b.doc_id
        GROUP BY a.doc_id, b.doc_id, na.n, nb.n
        HAVING 100 * COUNT(*) >= 80 * (na.n + nb.n - COUNT(*))
    ),
    b AS (SELECT x, y FROM l UNION ALL SELECT y, x FROM l),
    r AS (
        WITH RECURSIVE walk(x, y) AS (SELECT DISTINCT x, x FROM b UNION SELECT walk.x, b.y FROM walk JOIN b ON walk.y = b.x)
        SELECT x, MIN(y) AS y FROM walk GROUP BY x
    )
    SELECT n.doc_id, n.n AS n_shingles, COALESCE(r.y, n.doc_id) AS component_id FROM n LEFT JOIN r ON r.x = n.doc_id
""")
def op8_ngram_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All documents with the component of their 5-word-shingle Jaccard links."""
    return ngram_join.similarity_components(table(spark, sf_dir, "documents"))


@query()
def op9_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All documents with the lines that near-equal lines elsewhere replace."""
    return lines.dedup_lines(table(spark, sf_dir, "documents"))


@query()
def op10_url_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All pages, judged by rules and by the links between hosts."""
    return url_filter.judge(table(spark, sf_dir, "pages"))


@query()
def op11_bestfit(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All documents, packed whole into sequences of 1024 ids."""
    return bestfit.digest(bestfit.pack(table(spark, sf_dir, "documents")))


@query(f"""
    WITH d AS (SELECT row_number() OVER () AS d, COALESCE(lang, 'und') AS lang, {LOWER.format("COALESCE(text, '')")} AS text FROM documents),
    p AS (SELECT d, lang, unnest(regexp_split_to_array(text, '[.,;:!?\\x0A-\\x0D]')) AS piece FROM d),
    w AS (SELECT lang, list_filter(regexp_split_to_array(piece, '[\\x20\\x09]+'), lambda x: x <> '') AS words FROM p),
    g AS (
        SELECT lang, k, array_to_string(words[i : i + k - 1], ' ') AS phrase
        FROM (SELECT lang, words, k, unnest(range(1, len(words) - k + 2)) AS i FROM w, range(1, {collocations.LONGEST + 1}) t(k))
    ),
    f AS MATERIALIZED (SELECT lang, k, phrase, COUNT(*) AS f FROM g GROUP BY ALL HAVING COUNT(*) >= {collocations.LEAST}),
    n AS (SELECT lang, CAST(SUM(len(words)) AS BIGINT) AS n FROM w GROUP BY lang),
    c AS (SELECT *, string_split(phrase, ' ') AS words FROM f WHERE k > 1),
    s AS (
        SELECT lang, f, array_to_string(words[i : j], ' ') AS phrase
        FROM (SELECT lang, f, k, words, i, unnest(range(i + 1, k + 1)) AS j FROM (SELECT *, unnest(range(1, k)) AS i FROM c))
        WHERE j - i + 1 < k
    ),
    o AS (SELECT lang, phrase, MAX(f) AS f FROM s GROUP BY ALL),
    x AS (
        SELECT c.lang, c.phrase, c.f AS a, l.f AS l, r.f AS r, n.n, t.k,
               CAST((1000 * CAST(c.f AS HUGEINT) * n.n) // (CAST(l.f AS HUGEINT) * r.f) AS BIGINT) AS score
        FROM c JOIN n USING (lang) JOIN range(1, {collocations.LONGEST}) t(k) ON t.k < c.k
        JOIN f l ON l.lang = c.lang AND l.phrase = array_to_string(c.words[1 : t.k], ' ')
        JOIN f r ON r.lang = c.lang AND r.phrase = array_to_string(c.words[t.k + 1 :], ' ')
        WHERE NOT EXISTS (SELECT 1 FROM o WHERE o.lang = c.lang AND o.phrase = c.phrase AND 100 * o.f >= 100 * c.f)
    ),
    b AS (SELECT * FROM x QUALIFY row_number() OVER (PARTITION BY lang, phrase ORDER BY score, k) = 1)
    SELECT lang, row_number() OVER (PARTITION BY lang ORDER BY score DESC, a DESC, phrase) AS rank, phrase, a, l, r, n, score
    FROM b QUALIFY rank <= {collocations.PER_LANG}
""")
def op12_collocations(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The best phrases of each language of all documents."""
    return collocations.collocations(table(spark, sf_dir, "documents"))


@query()
def op13_whitening(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All vectors, whitened to their eight strongest components."""
    return whitening.whiten(table(spark, sf_dir, "embeddings"))
