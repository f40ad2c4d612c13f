"""One query for each operator, over its whole tables, with SQL twins where SQL can express the result."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from secdata.llm import decontaminate, html_extract, jaccard_join, langid, license_scan, mixing, quality, sharding, token_align, toxicity, vector_codes
from secdata.llm.line_dedup import op5_line_dedup
from secdata.llm.search import op10_topk_search
from secdata.llm.shared import join_hot, settle


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def held(mod: int, rest: int) -> F.Column:
    """Rows that nothing is learned from: crc32 of the id as text leaves ``rest``."""
    return F.pmod(F.crc32(F.col("doc_id").cast("string")), F.lit(mod)) == rest


def op1_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = decontaminate.find_windows(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))
    names = F.array_join(F.array_sort(F.transform("items", lambda i: i.cast("string"))), ",")
    return found.select("doc_id", "n_words", "n_hit", F.size("items").cast("long").alias("n_items"), F.sha2(names, 256).alias("items_sha256"), (F.col("n_hit") > 0).alias("contaminated"))


def op2_jaccard_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    return jaccard_join.components(table(spark, sf_dir, "documents")).select(F.col("doc").alias("doc_id"), F.col("n").alias("n_shingles"), F.col("component").alias("component_id"))


def op3_sharding(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text", F.crc32(F.coalesce("text", F.lit(""))).alias("text_crc32"))
    return sharding.assign(docs, shards=8).select("doc_id", "size", "text_crc32", F.lit("bytes").alias("law"), "shard", "slot", F.lit(None).cast("int").alias("grown_shard"))


def op4_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text", "lang").withColumn("held_out", held(3, 1))
    model = langid.fit(docs.where(~F.col("held_out")))
    return langid.predict(docs.select("doc_id", "held_out", "text"), model).drop("text")


def op6_html_extraction(spark: SparkSession, sf_dir: str) -> DataFrame:
    return html_extract.extract(table(spark, sf_dir, "pages").select("page_id", "url", "html")).withColumn("n_chars", F.length("text").cast("long"))


def op7_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text").withColumn("held_out", held(4, 2))
    model = quality.fit(docs, table(spark, sf_dir, "labels").where(~held(4, 2)))
    return quality.score(docs, model).drop("text")


def op8_source_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    mixed = mixing.mix(table(spark, sf_dir, "documents").select("doc_id", "source", "text"), entropy=0.95, repeats=2.0, budget_part=1.0)
    return mixed.select("doc_id", "source", "tokens", F.col("epoch").cast("long").alias("epoch"), F.col("block").cast("long").alias("block"))


def op9_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text").withColumn("held_out", held(3, 1))
    model = toxicity.fit(docs, table(spark, sf_dir, "labels").where(~held(3, 1)))
    return toxicity.score(docs, model).drop("text")


def op11_vector_codes(spark: SparkSession, sf_dir: str) -> DataFrame:
    vectors = table(spark, sf_dir, "embeddings").select("vec_id", "embedding", "label")
    books = vector_codes.fit(vectors)
    # The key tells a null label from all texts.
    coded = settle(vector_codes.encode(vectors, books).select("vec_id", "code", "error", F.coalesce(F.concat(F.lit("="), F.col("label").cast("string")), F.lit("")).alias("key")))
    sums = coded.groupBy("key").agg(F.sum("error").alias("label_error"))
    return join_hot(coded, sums, "key").select("vec_id", "code", "error", "label_error", F.lit(books.sha256()).alias("codebooks_sha256"))


def op12_token_alignment(spark: SparkSession, sf_dir: str) -> DataFrame:
    return token_align.digest(table(spark, sf_dir, "documents"))


def op13_license_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    scanned = license_scan.scan(table(spark, sf_dir, "documents").select("doc_id", "text"))
    return scanned.select("doc_id", *license_scan.digest(scanned))


_LOWER = "translate({}, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"

OP1_SQL = rf"""
WITH item AS (SELECT item_id, regexp_extract_all({_LOWER.format("text")}, '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w FROM benchmark WHERE text IS NOT NULL),
win AS (SELECT DISTINCT item_id, least(len(w), 10) AS m, array_to_string(w[i:i + least(len(w), 10) - 1], ' ') AS s
        FROM (SELECT item_id, w, unnest(range(1, len(w) - least(len(w), 10) + 2)) AS i FROM item WHERE len(w) > 0)),
doc AS (SELECT doc_id, coalesce(regexp_extract_all({_LOWER.format("text")}, '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+'), []) AS w FROM documents),
lens AS (SELECT DISTINCT m FROM win),
pos AS (SELECT doc_id, m, i, array_to_string(w[i:i + m - 1], ' ') AS s
        FROM (SELECT doc_id, w, m, unnest(range(1, len(w) - m + 2)) AS i FROM doc, lens WHERE len(w) >= m)),
hit AS (SELECT doc_id, item_id, i, pos.m FROM pos JOIN win ON pos.m = win.m AND pos.s = win.s),
words AS (SELECT doc_id, count(DISTINCT p) AS n_hit FROM (SELECT doc_id, unnest(range(i, i + m)) AS p FROM hit) GROUP BY doc_id),
items AS (SELECT doc_id, count(*) AS n_items, string_agg(CAST(item_id AS VARCHAR), ',' ORDER BY CAST(item_id AS VARCHAR)) AS names FROM (SELECT DISTINCT doc_id, item_id FROM hit) GROUP BY doc_id)
SELECT doc.doc_id, CAST(len(w) AS BIGINT) AS n_words, coalesce(n_hit, 0) AS n_hit, coalesce(n_items, 0) AS n_items,
       sha256(coalesce(names, '')) AS items_sha256, coalesce(n_hit, 0) > 0 AS contaminated
FROM doc LEFT JOIN words ON doc.doc_id = words.doc_id LEFT JOIN items ON doc.doc_id = items.doc_id
"""

OP2_SQL = rf"""
WITH RECURSIVE doc AS (SELECT doc_id, coalesce(regexp_extract_all({_LOWER.format("text")}, '[^\x20\x09-\x0D]+'), []) AS w FROM documents),
sh AS (SELECT DISTINCT doc_id, array_to_string(w[i:i + 4], ' ') AS s FROM (SELECT doc_id, w, unnest(range(1, greatest(len(w) - 4, 1) + 1)) AS i FROM doc WHERE len(w) > 0)),
size AS (SELECT doc_id, count(*) AS n FROM sh GROUP BY doc_id),
common AS (SELECT a.doc_id AS a, b.doc_id AS b, count(*) AS c FROM sh a JOIN sh b ON a.s = b.s AND a.doc_id <> b.doc_id GROUP BY a.doc_id, b.doc_id),
link AS (SELECT a, b FROM common JOIN size x ON x.doc_id = a JOIN size y ON y.doc_id = b WHERE 100 * c >= 75 * (x.n + y.n - c)),
reach AS (SELECT a AS doc_id, b AS other FROM link UNION SELECT reach.doc_id, link.b FROM reach JOIN link ON reach.other = link.a)
SELECT doc.doc_id, coalesce(n, 0) AS n_shingles, least(doc.doc_id, coalesce(low, doc.doc_id)) AS component_id
FROM doc LEFT JOIN size ON doc.doc_id = size.doc_id LEFT JOIN (SELECT doc_id, min(other) AS low FROM reach GROUP BY doc_id) r ON doc.doc_id = r.doc_id
"""


def _op8_sql(entropy: float = 0.95, repeats: float = 2.0, budget_part: float = 1.0, seed: str = "mix") -> str:
    n = mixing.SECTIONS

    def number(*parts: str) -> str:
        return "CAST('0x' || substr(md5(" + " || ':' || ".join(parts) + "), 1, 12) AS BIGINT)"

    ctes = [
        "doc AS (SELECT *, CASE WHEN text = '' THEN 0 ELSE length(text) - length(replace(replace(text, ' ', ''), chr(10), '')) + 1 END AS tokens FROM documents WHERE text IS NOT NULL AND doc_id IS NOT NULL)",
        "used AS (SELECT doc_id, source, tokens, coalesce('=' || source, 'null') AS s FROM doc WHERE tokens > 0)",
        "src AS (SELECT s, CAST(sum(tokens) AS BIGINT) AS tokens, count(*) AS n FROM used GROUP BY s)",
        "tot AS (SELECT CAST(sum(tokens) AS DOUBLE) AS t, count(*) AS n FROM src)",
        "flat0 AS (SELECT 0.0::DOUBLE AS low, 1.0::DOUBLE AS high), rep0 AS (SELECT 0.0::DOUBLE AS low, 1.0::DOUBLE AS high)",
    ]
    for kind, test in (("flat", f"ln(sum(m)) - sum(m * ln(m)) / sum(m) >= {entropy}::DOUBLE * ln((SELECT n FROM tot))"), ("rep", f"max(m / tokens) / sum(m) * ((SELECT t FROM tot) * {budget_part}::DOUBLE) <= {repeats}::DOUBLE + 1e-9::DOUBLE")):
        for r in range(mixing.ROUNDS):
            ctes.append(f"{kind}p{r} AS (SELECT i, low + (high - low) * i / {n}.0::DOUBLE AS a FROM {kind}{r}, range({n + 1}) t(i))")
            ctes.append(f"{kind}m{r} AS (SELECT i, a, tokens, pow(tokens / (SELECT t FROM tot), a) AS m FROM src, {kind}p{r})")
            ctes.append(f"{kind}g{r} AS (SELECT i FROM {kind}m{r} GROUP BY i, a HAVING {test})")
            pick = f"SELECT coalesce((SELECT max(i) FROM {kind}g{r}), 0) AS i" if kind == "flat" else f"SELECT coalesce((SELECT min(i) FROM {kind}g{r}), {n}) AS i"
            low, high = ("k.i", f"least({n}, k.i + 1)") if kind == "flat" else ("greatest(0, k.i - 1)", "k.i")
            ctes.append(f"{kind}{r + 1} AS (SELECT (SELECT a FROM {kind}p{r} WHERE i = {low}) AS low, (SELECT a FROM {kind}p{r} WHERE i = {high}) AS high FROM ({pick}) k)")
    ctes += [
        f"expo AS (SELECT CASE WHEN (SELECT n FROM tot) < 2 THEN 1.0 ELSE greatest((SELECT low FROM flat{mixing.ROUNDS}), (SELECT high FROM rep{mixing.ROUNDS})) END AS a)",
        "wt AS (SELECT s, tokens, n, pow(tokens / (SELECT t FROM tot), (SELECT a FROM expo)) AS m FROM src)",
        f"goal AS (SELECT s, tokens, n, least(CAST(floor(m / (SELECT sum(m) FROM wt) * ((SELECT t FROM tot) * {budget_part}::DOUBLE) + 1e-6::DOUBLE) AS BIGINT), CAST(floor(tokens * {repeats}::DOUBLE) AS BIGINT)) AS g FROM wt)",
        f"plan AS (SELECT s, g // tokens AS whole, g % tokens AS rest, least({mixing.MOST_BLOCKS}, CAST(ceil(n / {mixing.BLOCK_ROWS}.0) AS BIGINT)) AS blocks FROM goal)",
        f"ep AS (SELECT *, {number(repr(seed), 'CAST(doc_id AS VARCHAR)', 'CAST(epoch AS VARCHAR)')} % blocks AS block FROM (SELECT used.*, whole, rest, blocks, unnest(range(0, whole + 1)) AS epoch FROM used JOIN plan ON used.s = plan.s) WHERE epoch < whole OR rest > 0)",
        "bs AS (SELECT s, block, CAST(sum(tokens) AS BIGINT) AS n, min(rest) AS rest FROM ep WHERE epoch = whole GROUP BY s, block)",
        f"bo AS (SELECT s, block, n, rest, sum(n) OVER (PARTITION BY s ORDER BY {number(repr(seed), repr('block'), 'CAST(block AS VARCHAR)')}, block ROWS UNBOUNDED PRECEDING) AS fin FROM bs)",
        "tk AS (SELECT ep.*, rest_ - fin + n AS room, n FROM ep JOIN (SELECT s AS s_, block AS b_, rest AS rest_, fin, n FROM bo WHERE fin - n < rest) b ON ep.s = s_ AND ep.block = b_ WHERE epoch = whole)",
        f"bd AS (SELECT *, sum(tokens) OVER (PARTITION BY s, block ORDER BY {number(repr(seed), repr('row'), 'CAST(doc_id AS VARCHAR)')}, doc_id ROWS UNBOUNDED PRECEDING) AS upto FROM tk WHERE n > room)",
    ]
    cols = "doc_id, source, CAST(tokens AS BIGINT) AS tokens, CAST(epoch AS BIGINT) AS epoch, CAST(block AS BIGINT) AS block"
    return "WITH " + ",\n".join(ctes) + f"\nSELECT {cols} FROM ep WHERE epoch < whole UNION ALL SELECT {cols} FROM tk WHERE n <= room UNION ALL SELECT {cols} FROM bd WHERE upto <= room"


def _op11_sql(parts: int = 4, rounds: int = 4, entries: int = 256) -> str:
    ctes = [
        "kept AS MATERIALIZED (SELECT vec_id, label, row_number() OVER () AS r, list_transform(embedding, lambda x: floor(1024 * CAST(x AS DOUBLE))) AS z FROM embeddings WHERE embedding IS NOT NULL AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0)",
        f"pt AS MATERIALIZED (SELECT r, p, z[p * (len(z) // {parts}) + 1 : (p + 1) * (len(z) // {parts})] AS z FROM kept, range({parts}) t(p))",
        f"start AS (SELECT r, row_number() OVER (ORDER BY vec_id, z) - 1 AS e FROM kept WHERE vec_id IS NOT NULL QUALIFY e < {entries})",
        "b0 AS MATERIALIZED (SELECT p, e, z FROM pt JOIN start ON pt.r = start.r)",
    ]
    for k in range(rounds + 1):
        near = f"min(CAST(list_dot_product(pt.z, pt.z) - 2 * list_dot_product(pt.z, b.z) + list_dot_product(b.z, b.z) AS BIGINT) * {entries} + e)"
        ctes.append(f"a{k} AS MATERIALIZED (SELECT r, p, n % {entries} AS e, n // {entries} AS error FROM (SELECT r, pt.p, {near} AS n FROM pt JOIN b{k} b ON pt.p = b.p GROUP BY r, pt.p))")
        if k < rounds:
            ctes.append(f"m{k} AS (SELECT p, e, list(x ORDER BY j) AS z FROM (SELECT p, e, j, floor(sum(x) / count(*)) AS x FROM (SELECT a.p, a.e, unnest(pt.z) AS x, unnest(range(len(pt.z))) AS j FROM a{k} a JOIN pt ON a.r = pt.r AND a.p = pt.p) GROUP BY p, e, j) GROUP BY p, e)")
            ctes.append(f"b{k + 1} AS MATERIALIZED (SELECT b.p, b.e, coalesce(m.z, b.z) AS z FROM b{k} b LEFT JOIN m{k} m ON b.p = m.p AND b.e = m.e)")
    ctes.append(f"whole AS (SELECT r, string_agg(printf('%02x', e), '' ORDER BY p) AS code, CAST(sum(error) AS BIGINT) AS error FROM a{rounds} GROUP BY r)")
    ctes.append(f"book AS (SELECT sha256(string_agg(CAST(CAST(x AS BIGINT) AS VARCHAR), ',' ORDER BY p, e, j)) AS h FROM (SELECT p, e, unnest(z) AS x, unnest(range(len(z))) AS j FROM b{rounds}))")
    return "WITH " + ",\n".join(ctes) + "\nSELECT vec_id, code, error, CAST(sum(error) OVER (PARTITION BY label) AS BIGINT) AS label_error, h AS codebooks_sha256 FROM kept JOIN whole ON kept.r = whole.r, book"


QUERIES = {f.__name__: f for f in (op1_decontamination, op2_jaccard_join, op3_sharding, op4_language_id, op5_line_dedup, op6_html_extraction, op7_quality, op8_source_mixing, op9_toxicity, op10_topk_search, op11_vector_codes, op12_token_alignment, op13_license_scan)}
SQL = {"op1_decontamination": OP1_SQL, "op2_jaccard_join": OP2_SQL, "op8_source_mixing": _op8_sql(), "op11_vector_codes": _op11_sql()}
