"""Registered queries of the subpackage and their SQL twins. Each applies one operator to its whole table."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ballast.llm import chat, collocation, html_extract, langid, mixing, neardup, neighbour_vote, packing, pii, quality, secret_scan, vectors, whitening

Query = Callable[[SparkSession, str], DataFrame]


def _table(spark: SparkSession, root: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{root}/{name}.parquet")


def op1_suffix_array(spark: SparkSession, root: str) -> DataFrame:
    return html_extract.extract(_table(spark, root, "pages"))


def op2_line_first(spark: SparkSession, root: str) -> DataFrame:
    return quality.line_first(_table(spark, root, "documents"))


def op3_pii(spark: SparkSession, root: str) -> DataFrame:
    return pii.find(_table(spark, root, "documents"))


def op4_prefix_target(spark: SparkSession, root: str) -> DataFrame:
    probe = "</s>[INST] ok [/INST]"
    extra = spark.range(2).selectExpr("-1L AS conv_id", "id AS turn", "IF(id = 0, 'user', 'assistant') AS role", f"'{probe}' AS text")
    own = _table(spark, root, "conversations").select("conv_id", "turn", "role", "text")
    return chat.read_back(chat.expand(own.union(extra)))


def op5_secrets(spark: SparkSession, root: str) -> DataFrame:
    return secret_scan.scan(_table(spark, root, "documents"))


def op6_minhash(spark: SparkSession, root: str) -> DataFrame:
    return neardup.near_duplicates(_table(spark, root, "documents"), size=2, percent=80)


#: Target weights of the mix at each level of the tree. The tables have no domains: sources are dealt to four of them.
WEIGHTS = {
    "domain": {"domain0": 4, "domain1": 3, "domain2": 2, "domain3": 1},
    "lang": {"en": 5, "fr": 2, "de": 2, "es": 1},
    "source": {"src0": 3, "src5": 2},
}
EPOCHS, FRACTION, SEED = 2, 0.5, 7


def domain() -> Column:
    number = F.regexp_extract(F.col("source"), "([0-9]+)$", 1)
    return F.when(number != "", F.concat(F.lit("domain"), (number.cast("int") % 4).cast("string")))


def op7_mixing(spark: SparkSession, root: str) -> DataFrame:
    return mixing.mix(_table(spark, root, "documents"), domain(), WEIGHTS, EPOCHS, FRACTION, seed=SEED)


def op8_bin_slack(spark: SparkSession, root: str) -> DataFrame:
    import public_tokenizers

    files = (public_tokenizers.path("byte_bpe_50k.json"), public_tokenizers.path("byte_bpe_50k.tiktoken"))
    return packing.pack(_table(spark, root, "documents"), *files)


def op9_flat_graph(spark: SparkSession, root: str) -> DataFrame:
    table = _table(spark, root, "embeddings")
    return vectors.with_recall(table, vectors.near_vectors(table, limit=0.98), limit=0.98)


def op10_langid(spark: SparkSession, root: str) -> DataFrame:
    return langid.identify(_table(spark, root, "documents"))


def op11_whitening(spark: SparkSession, root: str) -> DataFrame:
    return whitening.whiten(_table(spark, root, "embeddings"))


def op12_collocation(spark: SparkSession, root: str) -> DataFrame:
    return collocation.mine(_table(spark, root, "documents"))


def op13_neighbour_vote(spark: SparkSession, root: str) -> DataFrame:
    return neighbour_vote.score(_table(spark, root, "documents"), _table(spark, root, "labels"))


def pipeline(spark: SparkSession, root: str) -> DataFrame:
    import corpus_pipeline

    return corpus_pipeline.run(spark, root)


QUERIES: dict[str, Query] = {
    "op1_suffix_array": op1_suffix_array,
    "op2_line_first": op2_line_first,
    "op3_pii": op3_pii,
    "op4_prefix_target": op4_prefix_target,
    "op5_secrets": op5_secrets,
    "op6_minhash": op6_minhash,
    "op7_mixing": op7_mixing,
    "op8_bin_slack": op8_bin_slack,
    "op9_flat_graph": op9_flat_graph,
    "op10_langid": op10_langid,
    "op11_whitening": op11_whitening,
    "op12_collocation": op12_collocation,
    "op13_neighbour_vote": op13_neighbour_vote,
    "pipeline": pipeline,
}


def _cases(level: str) -> str:
    rules = " ".join(f"WHEN {level} = '{value}' THEN CAST({weight} AS DOUBLE)" for value, weight in WEIGHTS[level].items())
    return f"CASE {rules} ELSE CAST(1 AS DOUBLE) END"


def _pour(nodes: str, parent: str, own: str) -> str:
    """SQL that splits `budget` of each parent over the rows of `nodes` by weight, none above its room."""
    return f"""
      SELECT *, CASE WHEN stand IS NULL THEN room ELSE LEAST(weight * stand, room) END AS share FROM (
        SELECT *, FIRST_VALUE(CASE WHEN level < fill THEN level END IGNORE NULLS) OVER (
          PARTITION BY {parent} ORDER BY fill, {own} ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS stand
        FROM (
          SELECT *, CASE WHEN weight > 0 THEN (budget - COALESCE(SUM(room) OVER (
              PARTITION BY {parent} ORDER BY fill, {own} ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0))
            / SUM(weight) OVER (
              PARTITION BY {parent} ORDER BY fill, {own} ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING)
            ELSE 0 END AS level
          FROM (SELECT *, CASE WHEN weight > 0 THEN room / weight ELSE 1e300 END AS fill FROM ({nodes}))))"""


def mixing_sql(docs: str = "documents") -> str:
    """The mix as one statement over `docs`; no weight of WEIGHTS is 0."""
    rows = f"""
      SELECT doc_id, CASE WHEN regexp_extract(source, '([0-9]+)$', 1) <> ''
          THEN 'domain' || CAST(CAST(regexp_extract(source, '([0-9]+)$', 1) AS INT) % 4 AS VARCHAR) ELSE '' END AS domain,
        COALESCE(lang, '') AS lang, COALESCE(source, '') AS source,
        CAST(COALESCE(len(regexp_extract_all(text, '[^\\x20\\x09-\\x0D]+')), 0) AS BIGINT) AS n_tokens,
        COALESCE(CAST(doc_id AS VARCHAR), 'n' || md5(COALESCE(text, ''))) AS name
      FROM {docs}"""
    top = _pour("SELECT * FROM tops", "1", "domain")
    middle = _pour("SELECT m.*, t.share AS budget FROM middles m JOIN poured_tops t USING (domain)", "domain", "lang")
    low = _pour("SELECT l.*, m.share AS budget FROM lows l JOIN poured_middles m USING (domain, lang)", "domain, lang", "source")
    return f"""
    WITH rows_ AS MATERIALIZED ({rows}),
    lows AS (SELECT domain, lang, source, SUM(n_tokens) AS n_tokens, CAST(SUM(n_tokens) * {EPOCHS} AS DOUBLE) AS room,
      {_cases("source")} AS weight FROM rows_ GROUP BY domain, lang, source),
    middles AS (SELECT domain, lang, SUM(room) AS room, SUM(n_tokens) AS n_all, {_cases("lang")} AS weight FROM lows GROUP BY domain, lang),
    tops AS (SELECT domain, SUM(room) AS room, {_cases("domain")} AS weight,
      CAST(FLOOR(SUM(SUM(n_all)) OVER () * CAST({FRACTION} AS DOUBLE)) AS DOUBLE) AS budget FROM middles GROUP BY domain),
    poured_tops AS ({top}),
    poured_middles AS ({middle}),
    poured AS ({low}),
    leaves AS (SELECT domain, lang, source, n_tokens AS leaf_tokens, CAST(FLOOR(share) AS BIGINT) AS budget FROM poured WHERE n_tokens > 0),
    placed AS (
      SELECT r.*, budget // leaf_tokens AS whole, budget % leaf_tokens AS rest,
        md5('{SEED}:' || CAST(budget // leaf_tokens AS VARCHAR) || ':' || name) AS key
      FROM rows_ r LEFT JOIN leaves USING (domain, lang, source)),
    running AS (
      SELECT *, SUM(n_tokens) OVER (PARTITION BY domain, lang, source ORDER BY key, doc_id, n_tokens
        ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS upto FROM placed)
    SELECT doc_id, domain, lang, source, n_tokens,
      CAST(COALESCE(whole, 0) + CASE WHEN rest > 0 AND upto <= rest THEN 1 ELSE 0 END AS BIGINT) AS uses
    FROM running"""


def collocation_sql(docs: str = "documents", least: int = collocation.LEAST, top: int = collocation.TOP) -> str:
    """Phrase collocations as one statement over `docs`, by hashed counts of all phrases."""
    upper = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"
    grams = " UNION ALL ".join(
        f"SELECT lang, {size} AS size, array_to_string(list_slice(ws, i, i + {size - 1}), ' ') AS phrase, "
        f"{f"array_to_string(list_slice(ws, i, i + {size - 2}), ' ')" if size > 1 else "''"} AS head, "
        f"{f"array_to_string(list_slice(ws, i + 1, i + {size - 1}), ' ')" if size > 1 else "''"} AS tail, "
        f"ws[i] AS first, ws[i + {size - 1}] AS last "
        f"FROM (SELECT lang, ws, unnest(range(1, len(ws) - {size - 2})) AS i FROM pieces WHERE len(ws) >= {size})"
        for size in (1, 2, 3)
    )
    score = "(CAST(1000000 AS HUGEINT) * c.a * c.a) // (CAST({l} AS HUGEINT) * {r})"
    return f"""
    WITH pieces AS MATERIALIZED (
      SELECT lang, regexp_extract_all(piece, '[^\x20\x09]+') AS ws FROM (
        SELECT COALESCE(lang, '{collocation.UNKNOWN}') AS lang,
          unnest(regexp_split_to_array(translate(COALESCE(text, ''), '{upper}', '{upper.lower()}'), '[.,;:!?\x0A-\x0D]')) AS piece
        FROM {docs})),
    totals AS (SELECT lang, CAST(SUM(len(ws)) AS BIGINT) AS n FROM pieces GROUP BY lang),
    counts AS MATERIALIZED (
      SELECT lang, size, phrase, ANY_VALUE(head) AS head, ANY_VALUE(tail) AS tail, ANY_VALUE(first) AS first, ANY_VALUE(last) AS last, COUNT(*) AS a
      FROM ({grams}) GROUP BY lang, size, phrase HAVING COUNT(*) >= {least}),
    cuts AS (
      SELECT c.*, 1 AS k, f.a AS l, t.a AS r, {score.format(l="f.a", r="t.a")} AS score FROM counts c
        JOIN counts f ON f.lang = c.lang AND f.size = 1 AND f.phrase = c.first
        JOIN counts t ON t.lang = c.lang AND t.size = c.size - 1 AND t.phrase = c.tail WHERE c.size > 1
      UNION ALL
      SELECT c.*, 2 AS k, h.a AS l, e.a AS r, {score.format(l="h.a", r="e.a")} AS score FROM counts c
        JOIN counts h ON h.lang = c.lang AND h.size = 2 AND h.phrase = c.head
        JOIN counts e ON e.lang = c.lang AND e.size = 1 AND e.phrase = c.last WHERE c.size = 3),
    lowest AS (SELECT * FROM cuts QUALIFY ROW_NUMBER() OVER (PARTITION BY lang, size, phrase ORDER BY score, k) = 1),
    longer AS (
      SELECT lang, phrase, MAX(a) AS a FROM (
        SELECT lang, head AS phrase, a FROM counts WHERE size = 3 UNION ALL SELECT lang, tail, a FROM counts WHERE size = 3)
      GROUP BY lang, phrase),
    kept AS (
      SELECT c.* FROM lowest c LEFT JOIN longer x ON x.lang = c.lang AND x.phrase = c.phrase AND c.size = 2
      WHERE x.a IS NULL OR 100 * x.a < {collocation.COVERED} * c.a)
    SELECT lang, rank, phrase, a, l, r, n, CAST(score AS BIGINT) AS score FROM (
      SELECT *, ROW_NUMBER() OVER (PARTITION BY lang ORDER BY score DESC, a DESC, phrase) AS rank FROM kept)
    JOIN totals USING (lang) WHERE rank <= {top}"""


SQL: dict[str, str] = {"op7_mixing": mixing_sql(), "op12_collocation": collocation_sql()}
