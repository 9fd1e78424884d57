"""One query per operator, each over whole tables."""

from __future__ import annotations

from concurrent.futures import ThreadPoolExecutor
from functools import reduce

import numpy as np
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from corpusvec.functions import text as T
from corpusvec.functions import vectors as V
from corpusvec.operators import alignment, assemble, chunk, embed, ordinals, quality, search
from corpusvec.plans import build, merge, query
from corpusvec.session import scratch_path
from corpusvec.sinks import artifacts, publish
from corpusvec.sources import files, index_store
from corpusvec.streaming import incremental

DIM = 64
EMBEDDER = embed.HashingEmbedder(DIM)
MODEL = "signed word hashing"
N_FILES, FILES_PER_SPLIT = 75, 15
SHARD = 500
# Fewer bytes for more CPU, where one task has to read much.
SMALL_PARQUET = {"compression": "zstd", "parquet.compression.codec.zstd.level": "6"}
# Vectored reads are missing in what Spark says that a task read.
COUNTED_READS = {"parquet.hadoop.vectored.io.enabled": "false"}


# Inputs --------------------------------------------------------------------


def table(spark: SparkSession, sf: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf}/{name}.parquet")


def documents(spark: SparkSession, sf: str) -> DataFrame:
    return files.widen(table(spark, sf, "documents"), "doc_id")


def first_line(text: Column) -> Column:
    return F.left(F.substring_index(text, "\n", 1), F.lit(60))


def plain_documents(spark: SparkSession, sf: str) -> DataFrame:
    """The documents as records of 75 files, dealt out in turn."""
    return documents(spark, sf).select(
        "doc_id",
        "source",
        "lang",
        (F.col("doc_id") % N_FILES).cast("int").alias("file_index"),
        ordinals.whole_parts(F.col("doc_id"), N_FILES).alias("row"),
        first_line(F.col("text")).alias("title"),
        F.col("text").alias("document"),
    )


def article_documents(spark: SparkSession, sf: str) -> DataFrame:
    articles = documents(spark, sf).select(
        "doc_id",
        "source",
        (F.col("doc_id") % N_FILES).cast("int").alias("file_index"),
        ordinals.whole_parts(F.col("doc_id"), N_FILES).alias("row"),
        first_line(F.col("text")).alias("title"),
        "text",
        F.array("lang", "source").alias("categories"),
    )
    return assemble.assemble_articles(articles)


def qa_records(spark: SparkSession, sf: str) -> DataFrame:
    """One question per conversation: its opening, its replies, its roles.

    Only the first few turns of each role are needed, so each role is limited
    to those before turns are brought together.
    """
    kept = assemble.MAX_ANSWERS + 2
    order = F.row_number().over(
        Window.partitionBy("conv_id", "role").orderBy("turn")
    )
    turns = table(spark, sf, "conversations").withColumn("n", order).filter(F.col("n") <= kept)

    def reply(n: int) -> Column:
        return F.max(F.when((F.col("role") == "assistant") & (F.col("n") == n), F.col("text")))

    question = F.max(F.when(F.col("turn") == 0, F.col("text")))
    replies = turns.groupBy("conv_id").agg(
        F.sort_array(F.collect_set("role")).alias("tags"),
        question.alias("question"),
        reply(1).alias("accepted_answer"),
        F.array_compact(F.array(*(reply(n) for n in range(2, kept + 1)))).alias("answers"),
    )
    return replies.withColumn("title", first_line(F.col("question")))


# Tighter limits than the defaults, so that these texts run into them.
TIGHT_CAPS = (200, 150, 100)


def qa_documents(spark: SparkSession, sf: str, **caps: tuple[int, int, int]) -> DataFrame:
    assembled = assemble.assemble_qa(qa_records(spark, sf), **caps)
    return assembled.select(
        "conv_id",
        F.lit("conversations").alias("source"),
        F.lit(0).alias("file_index"),
        F.col("conv_id").alias("row"),
        "title",
        "document",
    )


def latex(text: Column) -> Column:
    """The text with a few commands around it."""
    return F.concat(
        F.lit("\\section{Intro} \\emph{"),
        F.substring_index(text, " ", 1),
        F.lit("} \\cite{ref} costs \\$5, $$x_1$$ and \\alpha\\beta{} "),
        text,
        F.lit(" \\textbf{end}"),
    )


def paper_records(spark: SparkSession, sf: str) -> DataFrame:
    """Papers in both forms, as parsed JSON."""
    docs = documents(spark, sf)
    number = F.col("doc_id")
    redpajama = F.to_variant_object(
        F.struct(
            latex(F.col("text")).alias("text"),
            F.struct(
                F.concat(F.lit("p"), number.cast("string")).alias("arxiv_id"),
                F.lpad((number % 10_000).cast("string"), 4, "0").alias("yymm"),
            ).alias("meta"),
        )
    )
    standard = F.to_variant_object(
        F.struct(
            F.concat(F.lit("p"), number.cast("string")).alias("id"),
            F.array("lang", "source").alias("categories"),
            first_line(F.col("text")).alias("title"),
            F.slice(T.words(F.col("text")), 1, 7).alias("authors"),
            latex(F.col("text")).alias("abstract"),
        )
    )
    return docs.select("doc_id", redpajama.alias("redpajama"), standard.alias("standard"))


def papers(spark: SparkSession, sf: str, form: str) -> DataFrame:
    fields = assemble.paper_fields(F.col(form))
    return paper_records(spark, sf).select("doc_id", *(c.alias(n) for n, c in fields.items()))


def raw_lines(spark: SparkSession, sf: str) -> DataFrame:
    """Articles as JSON lines; each language but one is broken in its own way."""
    record = F.struct(
        F.when(F.col("lang") == "fr", F.lit(None)).otherwise(F.lit("t")).alias("title"), "text"
    )
    line = F.to_json(record, {"ignoreNullFields": "false"})
    broken = (
        F.when(F.col("lang") == "de", F.left(line, F.length(line) - 1))
        .when(F.col("lang") == "es", F.concat(F.lit("["), line, F.lit("]")))
        .otherwise(line)
    )
    lines = documents(spark, sf).select("doc_id", "source", broken.alias("value"))
    return lines.withColumn("v", F.try_parse_json("value"))


def numbered_chunks(spark: SparkSession, sf: str) -> DataFrame:
    return ordinals.assign_vec_ids(build.documents_to_chunks(plain_documents(spark, sf)))


def entries(spark: SparkSession, sf: str) -> DataFrame:
    return build.documents_to_entries(plain_documents(spark, sf), EMBEDDER)


def stored(df: DataFrame, name: str) -> DataFrame:
    """Written once to the shared folder, and read back by whoever needs it."""
    path = scratch_path(df.sparkSession, name)
    df.write.parquet(path)
    return df.sparkSession.read.parquet(path)


def write_json_files(df: DataFrame, path: str, n_files: int) -> None:
    """The rows as ``n_files`` JSON files, dealt out in turn.

    A file is one task's work, which so reads an ``n_files``-th of the rows, however many there are.
    All tasks first deal their rows into Zstandard files, which take less than a shuffle's blocks;
    nothing is shuffled.
    """
    stage = scratch_path(df.sparkSession, "dealt")
    dealt = df.withColumn("_file", (F.monotonically_increasing_id() % n_files).cast("int"))
    dealt.write.partitionBy("_file").options(**SMALL_PARQUET).parquet(stage)
    # From Spark 4.1 on, a union of single partitions is one partition, which has to be refused.
    session = df.sparkSession.newSession()
    session.conf.set("spark.sql.unionOutputPartitioning", "false")
    kept = session.read.schema(dealt.schema).options(**COUNTED_READS).parquet(stage)
    shares = [kept.filter(F.col("_file") == n).drop("_file").coalesce(1) for n in range(n_files)]
    reduce(DataFrame.union, shares).write.json(path)


def text_queries(spark: SparkSession, sf: str) -> DataFrame:
    return query.embed_queries(table(spark, sf, "benchmark"), EMBEDDER, "item_id")


def vectors(spark: SparkSession, sf: str) -> DataFrame:
    return table(spark, sf, "embeddings").withColumnRenamed("embedding", "vector")


def twentieth(spark: SparkSession, sf: str) -> DataFrame:
    """The queries of the searches: every vector whose id is divisible by 20."""
    index = vectors(spark, sf).filter(F.col("vec_id") % 20 == 0)
    return index.select(F.col("vec_id").alias("query_id"), "vector")


def scaled(spark: SparkSession, sf: str) -> DataFrame:
    factor = F.col("label") + 1
    return vectors(spark, sf).select(
        "vec_id",
        "label",
        F.transform(V.to_double(F.col("vector")), lambda x: x * factor).alias("vector"),
    )


def long_form(df: DataFrame, key: str, vector: str = "vector", decimals: int = 6) -> DataFrame:
    return df.select(key, F.posexplode(V.to_double(F.col(vector))).alias("dim", "x")).select(
        key, "dim", (F.round("x", decimals) + 0.0).alias("value")
    )


def rounded(hits: DataFrame) -> DataFrame:
    return hits.withColumn("score", F.round("score", 6) + 0.0)


def published(spark: SparkSession, sf: str) -> index_store.Index:
    return build.build_index(
        spark,
        plain_documents(spark, sf),
        scratch_path(spark, "index"),
        EMBEDDER,
        dataset="documents",
        model=MODEL,
        source_path=sf,
        shard_size=SHARD,
    )


# Sources -------------------------------------------------------------------


def scan_jsonl(spark, sf):
    path = scratch_path(spark, "lines")
    docs = table(spark, sf, "documents").select("doc_id", "text", "lang")
    # Four files, and more where the table has more parts, so that none grows with the table.
    n_files = max(4, docs.rdd.getNumPartitions())
    docs.repartitionByRange(n_files, "doc_id").sortWithinPartitions("doc_id").write.json(path)
    lines = files.scan_jsonl(spark, path, suffix="json").withColumn("chunk", F.lit(0))
    return ordinals.assign_vec_ids(lines).select(
        F.col("vec_id").alias("position"),
        F.variant_get("v", "$.doc_id", "bigint").alias("doc_id"),
        F.variant_get("v", "$.lang", "string").alias("lang"),
        F.variant_get("v", "$.text", "string").alias("text"),
    )


def scan_parquet(spark, sf):
    return files.scan_parquet(spark, f"{sf}/documents.parquet", ["doc_id", "lang", "n_chars"])


def discover_files(spark, sf):
    path = scratch_path(spark, "mixed")
    write_json_files(table(spark, sf, "documents").select("doc_id", "text"), path, 3)
    table(spark, sf, "benchmark").repartition(2).write.mode("append").parquet(path)
    found = files.discover_files(spark, path, ("json", "parquet"))
    rows = files.scan_directory(spark, path, line_suffix="json")
    per_file = rows.groupBy("file_index").agg(F.count(F.lit(1)).alias("rows"))
    return (
        found.join(per_file, "file_index")
        .groupBy("kind")
        .agg(
            F.count(F.lit(1)).alias("files"),
            F.sum("rows").alias("rows"),
            F.count_if(~F.col("file_index").between(0, 4)).alias("outside"),
        )
    )


def row_provenance(spark, sf):
    scan = files.scan_parquet(spark, f"{sf}/documents.parquet")
    return files.with_row_numbers(scan.drop("source")).select("doc_id", "source", "row")


def file_range_split(spark, sf):
    docs = plain_documents(spark, sf).select("doc_id", "file_index")
    parts = None
    for start in range(0, N_FILES, FILES_PER_SPLIT):
        part = files.split_by_file_range(docs, start, start + FILES_PER_SPLIT).withColumn(
            "split_id", files.split_of_file(F.col("file_index"), FILES_PER_SPLIT)
        )
        parts = part if parts is None else parts.unionByName(part)
    return parts


def concat_shards(spark, sf):
    path = scratch_path(spark, "shards")
    docs = table(spark, sf, "documents")
    lines = docs.select("lang", F.to_json(F.struct("doc_id", "text")).alias("value"))
    lines.write.partitionBy("lang").text(path)
    # The last shard is not there, and is skipped.
    found = [r["lang"] for r in docs.select("lang").distinct().collect()]
    names = [f"lang={lang}" for lang in (*sorted(found), "absent")]
    read = files.concat_shards(spark, path, names, pattern="part-*")
    plain = read.withColumn("shard", F.substring_index("shard", "=", -1))
    characters = plain.rollup("shard").agg(F.sum(F.length(F.get_json_object("value", "$.text"))).alias("chars"))
    counted = files.shard_line_counts(plain)
    return counted.join(
        characters.withColumnRenamed("shard", "_shard"), F.col("shard").eqNullSafe(F.col("_shard"))
    ).drop("_shard")


def scan_text_corpus(spark, sf):
    path = scratch_path(spark, "texts")
    items = table(spark, sf, "benchmark").select("text")
    items.write.option("maxRecordsPerFile", 1).text(path)
    read = files.scan_text_dir(spark, path)
    return read.select(
        F.substring_index("doc_id", ".", -1).alias("suffix"),
        T.strip(F.col("text")).alias("text"),
    )


def load_index(spark, sf):
    published_at = published(spark, sf).path
    return index_store.load_index(spark, published_at).metadata


def source_row_counts(spark, sf):
    return files.count_rows_per_file(spark.read.parquet(f"{sf}/documents.parquet"))


# Sinks ---------------------------------------------------------------------


def _lines_in_order(spark: SparkSession, path: str) -> DataFrame:
    lines = files.scan_jsonl(spark, path, suffix="json").withColumn("chunk", F.lit(0))
    return ordinals.assign_vec_ids(lines).withColumnRenamed("vec_id", "position")


def write_chunks(spark, sf):
    path = scratch_path(spark, "artifacts")
    artifacts.write_lines(numbered_chunks(spark, sf), path)
    return _lines_in_order(spark, f"{path}/chunks").select(
        "position", F.variant_get("v", "$.text", "string").alias("text")
    )


def write_metadata(spark, sf):
    path = scratch_path(spark, "artifacts")
    artifacts.write_lines(numbered_chunks(spark, sf), path)

    def get(name: str, kind: str) -> Column:
        return F.variant_get("v", f"$.{name}", kind).alias(name)

    return _lines_in_order(spark, f"{path}/metadata").select(
        "position",
        get("source", "string"),
        get("file_index", "int"),
        get("row", "bigint"),
        get("chunk", "int"),
        get("title", "string"),
    )


def write_vector_shards(spark, sf):
    path = scratch_path(spark, "shards")
    artifacts.write_vector_shards(vectors(spark, sf), path, shard_size=200, file_vectors=50)
    placed = spark.read.parquet(path).select(
        F.col("shard_id").cast("int").alias("shard_id"),
        "vec_id",
        weighted("vector").alias("weighted"),
        F.col("_metadata.file_path").alias("file"),
        F.col("_metadata.row_index").alias("at"),
    )
    before = F.lag("vec_id").over(Window.partitionBy("file").orderBy("at"))
    return (
        placed.withColumn("disordered", before + 1 != F.col("vec_id"))
        .groupBy("shard_id")
        .agg(
            F.count(F.lit(1)).alias("vectors"),
            F.min("vec_id").alias("first_id"),
            F.max("vec_id").alias("last_id"),
            F.round(F.sum("weighted"), 4).alias("weighted"),
            F.count_if("disordered").alias("disordered"),
            F.max("at").alias("last_row"),
        )
    )


def write_summary(spark, sf):
    """Manifests of an index whose parts fit together, and of one whose parts do not."""
    index = vectors(spark, sf).select("vec_id")
    _, chunks, metadata = _parts(spark, sf)
    written = None
    for name, parts in (("whole", (index, index, index)), ("torn", (index, chunks, metadata))):
        path = scratch_path(spark, "summary")
        passed = alignment.integrity_gate(*parts).first()["status"] == "PASSED"
        artifacts.write_summary(artifacts.summary_row(index, name, "given", MODEL, DIM, passed), path)
        one = spark.read.json(path)
        written = one if written is None else written.unionByName(one)
    return written.select(
        "dataset_name", "total_vectors", "embedding_model", "embedding_dimension",
        "integrity_status",
    )


def artifact_manifest(spark, sf):
    path = scratch_path(spark, "artifacts")
    items = table(spark, sf, "benchmark").select("text")
    items.write.option("maxRecordsPerFile", 1).text(f"{path}/texts")
    manifest = artifacts.artifact_manifest(spark, path)
    return manifest.filter(F.col("file").endswith(".txt")).select("artifact", "bytes", "sha256")


def publish_verified(spark, sf):
    path = scratch_path(spark, "published")
    index = publish.publish_verified(
        spark,
        vectors(spark, sf).withColumn("text", F.lit("")).withColumn("source", F.lit("given")),
        path,
        dataset="embeddings",
        model=MODEL,
        dimension=DIM,
        shard_size=SHARD,
    )
    return index.summary.select("dataset_name", "total_vectors", "integrity_status")


# Assembly and filters ------------------------------------------------------


def assemble_articles(spark, sf):
    return article_documents(spark, sf).select("doc_id", "document")


def assemble_qa(spark, sf):
    return qa_documents(spark, sf, caps=TIGHT_CAPS).select("conv_id", "document")


def assemble_papers_redpajama(spark, sf):
    assembled = assemble.assemble_papers_redpajama(papers(spark, sf, "redpajama"))
    return assembled.select("doc_id", "document")


def assemble_papers_standard(spark, sf):
    assembled = assemble.assemble_papers_standard(papers(spark, sf, "standard"))
    return assembled.select("doc_id", "document")


def clean_latex_corpus(spark, sf):
    docs = documents(spark, sf)
    return docs.select("doc_id", T.clean_latex(latex(F.col("text"))).alias("cleaned"))


def encode_prefix(spark, sf):
    def prefixed(name: str, key: str, kind: str) -> DataFrame:
        rows = table(spark, sf, name).select(F.lit(kind).alias("kind"), F.col(key).alias("id"), "text")
        return assemble.encode_prefix(rows, kind).drop("text")

    passages = prefixed("documents", "doc_id", "passage")
    return passages.unionByName(prefixed("benchmark", "item_id", "query"))


def chunk_metadata(spark, sf):
    return assemble.chunk_metadata(build.documents_to_chunks(plain_documents(spark, sf)))


def drop_empty_documents(spark, sf):
    # Documents of a word or two stand in for blank ones.
    blanked = plain_documents(spark, sf).withColumn(
        "document",
        F.when(F.length("document") < 20, F.lit(" \n ")).otherwise(F.col("document")),
    )
    return assemble.drop_empty_documents(blanked).select("doc_id")


def drop_short_chunks(spark, sf):
    chunks = chunk.chunk_words(plain_documents(spark, sf))
    return chunk.drop_short_chunks(chunks).select("doc_id", "chunk")


def quarantine_malformed(spark, sf):
    good, bad = quality.quarantine_malformed(raw_lines(spark, sf), "article")
    kept = good.select("doc_id", F.lit("kept").alias("reason"))
    return kept.unionByName(bad.select("doc_id", "reason"))


def filter_by_label(spark, sf):
    labelled = table(spark, sf, "documents").withColumn("categories", F.array("lang", "source"))
    return assemble.filter_by_label(labelled, "categories", ["fr", "src3"]).select("doc_id")


# Chunks --------------------------------------------------------------------


def chunk_words(spark, sf):
    return chunk.chunk_words(plain_documents(spark, sf)).select("doc_id", "chunk", "text")


def chunk_words_overlap(spark, sf):
    return chunk.chunk_words_overlap(plain_documents(spark, sf)).select("doc_id", "chunk", "text")


def chunk_stats(spark, sf):
    return chunk.chunk_stats(plain_documents(spark, sf)).drop("text")


# Vectors -------------------------------------------------------------------


def embed_chunks(spark, sf):
    return long_form(entries(spark, sf), "vec_id")


def l2_normalize(spark, sf):
    unit = scaled(spark, sf).withColumn("vector", V.l2_normalize(F.col("vector")))
    return long_form(unit, "vec_id")


def _paired(left: DataFrame, spark: SparkSession, sf: str) -> DataFrame:
    """Every vector beside the query with the largest id up to its own."""
    queries = twentieth(spark, sf).withColumnRenamed("vector", "query")
    return left.withColumn("query_id", F.col("vec_id") - F.col("vec_id") % 20).join(queries, "query_id")


def inner_product(spark, sf):
    paired = _paired(scaled(spark, sf), spark, sf)
    score = V.inner_product(F.col("vector"), F.col("query"))
    return rounded(paired.select("vec_id", score.alias("score")))


def cosine_similarity(spark, sf):
    paired = _paired(scaled(spark, sf), spark, sf)
    score = V.cosine(F.col("vector"), F.col("query"))
    return rounded(paired.select("vec_id", score.alias("score")))


def vector_validation(spark, sf):
    stats = embed.validate_vectors(vectors(spark, sf), DIM)
    return stats.withColumn("min_norm", F.round("min_norm", 4)).withColumn(
        "max_norm", F.round("max_norm", 4)
    )


def vector_precision_cast(spark, sf):
    tenth = scaled(spark, sf).withColumn(
        "vector", V.to_float32(F.transform("vector", lambda x: x * 0.1))
    )
    return long_form(tenth, "vec_id", decimals=9)


def embedder_udf(spark, sf):
    letters = embed.BatchEmbedder(_load_letter_counter, 26)
    docs = documents(spark, sf).select("doc_id", "text")
    return long_form(letters.embed(docs, "text", "vector"), "doc_id")


def _load_letter_counter():
    def encode(texts: list[str]) -> np.ndarray:
        """Letters a to z of each text, counted over the bytes of the whole batch."""
        raw = [t.encode() for t in texts]
        data = np.frombuffer(b"".join(raw), np.uint8)
        owner = np.repeat(np.arange(len(raw)), [len(r) for r in raw])
        letter = (data >= ord("a")) & (data <= ord("z"))
        cells = owner[letter] * 26 + (data[letter] - ord("a"))
        return np.bincount(cells, minlength=len(raw) * 26).reshape(len(raw), 26).astype(float)

    return encode


# Joins ---------------------------------------------------------------------


def _parts(spark: SparkSession, sf: str) -> tuple[DataFrame, DataFrame, DataFrame]:
    """Three tables of different size, seen as parts of one index."""
    chunks = table(spark, sf, "documents").select(F.col("doc_id").alias("vec_id"), "text")
    metadata = table(spark, sf, "labels").select(F.col("doc_id").alias("vec_id"), "quality")
    return vectors(spark, sf).select("vec_id", "label"), chunks, metadata


def align_triple(spark, sf):
    return alignment.align_triple(*_parts(spark, sf))


def alignment_audit(spark, sf):
    return alignment.alignment_audit(*_parts(spark, sf))


def result_lookup(spark, sf):
    hits = search.topk_batch(vectors(spark, sf), twentieth(spark, sf), 10)
    docs = table(spark, sf, "documents").select(F.col("doc_id").alias("vec_id"), "lang", "n_chars")
    return rounded(search.result_lookup(hits, docs))


def score_pairs(spark, sf):
    """Every vector with the queries before and behind it; the last has none behind."""
    index = vectors(spark, sf)
    before = F.col("vec_id") - F.col("vec_id") % 20
    pairs = index.select("vec_id", F.explode(F.array(before, before + 20)).alias("query_id"))
    return rounded(search.score_pairs(pairs, twentieth(spark, sf), index))


# Search --------------------------------------------------------------------


def topk_single(spark, sf):
    index = vectors(spark, sf)
    first = index.select("vec_id", "vector").orderBy("vec_id").first()
    return rounded(search.topk_single(index, first["vector"], 10))


def topk_batch(spark, sf):
    return rounded(search.topk_batch(vectors(spark, sf), twentieth(spark, sf), 10))


def topk_with_sources(spark, sf):
    """Every benchmark text asked of a published index of the documents."""
    asked = table(spark, sf, "benchmark").withColumnRenamed("item_id", "query_id")
    hits = query.search_index(published(spark, sf), asked, EMBEDDER, k=3)
    return rounded(hits).select(
        "query_id", "rank", "score", "vec_id", "preview", "source", "file_index", "row", "chunk"
    )


def topk_filtered(spark, sf):
    """Search among the articles of one category in a published index."""
    category = F.array("lang", "source").alias("categories")
    records = documents(spark, sf).select(
        "source",
        (F.col("doc_id") % N_FILES).cast("int").alias("file_index"),
        ordinals.whole_parts(F.col("doc_id"), N_FILES).alias("row"),
        F.to_variant_object(F.struct(first_line(F.col("text")).alias("title"), "text", category)).alias("v"),
    )
    index = build.build_index(
        spark,
        stored(build.assemble_records(records, "article"), "articles"),
        scratch_path(spark, "index"),
        EMBEDDER,
        dataset="articles",
        model=MODEL,
        shard_size=SHARD,
        labels=["categories"],
    )
    chosen = index_store.labelled(index, all_of=[("categories", "src3"), ("categories", "en")])
    return rounded(search.topk_batch(chosen, text_queries(spark, sf), 10))


def score_bands(spark, sf):
    return search.score_bands(search.topk_batch(vectors(spark, sf), twentieth(spark, sf), 10))


def topk_per_index(spark, sf):
    index = vectors(spark, sf).withColumn("index_id", F.col("label").cast("string"))
    return rounded(search.topk_per_index(index, twentieth(spark, sf), 5))


def topk_block(spark, sf):
    index = stored(entries(spark, sf).select("vec_id", "vector"), "vectors")
    return rounded(search.topk_block(index, text_queries(spark, sf), 10, block_bytes=8 << 10))


# Counts and gates ----------------------------------------------------------


def estimate_chunks_by_length(spark, sf):
    return quality.estimate_chunks_by_length(article_documents(spark, sf))


def estimate_chunks_by_rows(spark, sf):
    return quality.estimate_chunks_by_rows(table(spark, sf, "documents"))


def chunks_per_document(spark, sf):
    chunks = build.documents_to_chunks(plain_documents(spark, sf))
    counted = quality.chunks_per_document(chunks, ["doc_id"])
    return counted.withColumn("chunks_per_document", F.round("chunks_per_document", 6))


def _corpora(spark: SparkSession, sf: str) -> dict[str, DataFrame]:
    return {
        "articles": build.documents_to_chunks(article_documents(spark, sf).drop("doc_id")),
        "questions": build.documents_to_chunks(qa_documents(spark, sf).drop("conv_id")),
    }


def corpus_totals(spark, sf):
    return quality.corpus_totals(merge.union_corpora(_corpora(spark, sf)), "index_id")


def ingest_counts(spark, sf):
    v = F.col("v")
    records = raw_lines(spark, sf).select(
        "source",
        v.isNull().alias("malformed"),
        assemble.article_document(
            *(assemble.article_fields(v)[n] for n in ("title", "text", "categories"))
        ).alias("document"),
    )
    return quality.ingest_counts(records)


def shard_accounting(spark, sf):
    return quality.shard_accounting(numbered_chunks(spark, sf), SHARD)


def estimate_vs_actual(spark, sf):
    docs = plain_documents(spark, sf)
    return quality.estimate_vs_actual(
        quality.estimate_chunks_by_length(docs), build.documents_to_chunks(docs)
    )


def integrity_gate(spark, sf):
    """A corpus whose parts fit together, and the same with its short chunks left in one part."""
    docs = plain_documents(spark, sf)
    chunks = build.documents_to_chunks(docs)
    texts, metadata = chunks.select("text"), assemble.chunk_metadata(chunks)
    expected = build.expected_chunks(docs)
    every = chunk.chunk_words(docs).select("text")
    whole = alignment.integrity_gate(chunks, texts, metadata, expected)
    torn = alignment.integrity_gate(chunks, every, metadata, expected)
    return whole.unionByName(torn)


def manifest_match(spark, sf):
    index = vectors(spark, sf)
    summary = artifacts.summary_row(index, "embeddings", "given", MODEL, DIM, False)
    _, chunks, metadata = _parts(spark, sf)
    return alignment.manifest_match(summary, index, chunks, metadata)


def chunk_quality(spark, sf):
    document = F.col("document")
    spanned = plain_documents(spark, sf).select(
        chunk.chunked_text(document).alias("document"), chunk.word_spans(document).alias("spans")
    )
    rates = quality.chunk_quality(spanned)
    return rates.withColumn("mid_word_breaks", F.round("mid_word_breaks", 6)).withColumn(
        "self_contained", F.round("self_contained", 6)
    )


# Ordinals and merging ------------------------------------------------------


def assign_vec_ids(spark, sf):
    return numbered_chunks(spark, sf).select("vec_id", "doc_id", "chunk")


def sample_limit(spark, sf):
    return ordinals.sample_limit(numbered_chunks(spark, sf), 150).select("vec_id", "doc_id", "chunk")


def split_indexes(spark: SparkSession, sf: str) -> list[str]:
    """Five stored split indexes and one that is not there."""
    root, at = scratch_path(spark, "splits"), scratch_path(spark, "documents")
    split_id = files.split_of_file(F.col("file_index"), FILES_PER_SPLIT)
    # A folder for every split, so that building it reads nothing of the others.
    dealt = plain_documents(spark, sf).withColumn("split", split_id)
    dealt.write.partitionBy("split").parquet(at)
    docs = spark.read.schema(dealt.schema).parquet(at)

    def build_split(i: int) -> str:
        own = docs.filter(F.col("split") == i).drop("split")
        part = files.split_by_file_range(own, i * FILES_PER_SPLIT, (i + 1) * FILES_PER_SPLIT)
        path = f"{root}/split{i}"
        build.build_index(spark, part, path, EMBEDDER, f"split{i}", MODEL, shard_size=SHARD)
        return path

    # The builds share no data: while one waits for its files, others use the cores.
    splits = range(N_FILES // FILES_PER_SPLIT)
    with ThreadPoolExecutor(len(splits)) as pool:
        paths = list(pool.map(build_split, splits))
    paths.insert(2, f"{root}/absent")
    return paths


def weighted(vector: str) -> Column:
    """A number that depends on every component and its place."""
    return F.aggregate(
        F.transform(V.to_double(F.col(vector)), lambda x, i: x * (i + 1)),
        F.lit(0.0),
        lambda total, x: total + x,
    )


def merge_splits(spark, sf):
    """Split indexes merged without their vectors, and read as one."""
    return read_merged(spark, split_indexes(spark, sf))


def read_merged(spark: SparkSession, paths: list[str]) -> DataFrame:
    merged = merge.merge_splits(spark, paths, scratch_path(spark, "merged"), "merged")
    summary = merged.summary.select("split_merge", "num_splits", "total_vectors").first()
    return merged.entries.select(
        "vec_id",
        "split_id",
        "doc_id",
        "chunk",
        F.round(weighted("vector"), 5).alias("weighted"),
        F.lit(summary["split_merge"]).alias("split_merge"),
        F.lit(summary["num_splits"]).cast("long").alias("num_splits"),
        F.lit(summary["total_vectors"]).alias("total_vectors"),
    )


def mini_index(spark, sf):
    """A directory with a text file for every document, indexed in overlapping chunks."""
    source, path = scratch_path(spark, "texts"), scratch_path(spark, "mini")
    texts = table(spark, sf, "documents").select("text")
    # A file for every text; a carriage return would end a line.
    lines = texts.select(F.regexp_replace("text", r"[\r\n]", " ").alias("value"))
    artifacts.write_texts(lines, source, "value")
    index = build.index_texts(spark, source, path, EMBEDDER, "texts", MODEL, shard_size=SHARD)
    # What a session leaves is removed by its driver, which would hold the name of every text.
    artifacts.remove_texts(spark, source)
    summary = build.text_index_summary(index).first()
    number = F.split("chunk_id", "__chunk_")[1]
    return index.entries.select(
        "text",
        "chunk_index",
        "chunk_count",
        "char_count",
        "word_count",
        (number == T.padded(F.col("chunk_index"), 3)).alias("named"),
        F.round(weighted("vector"), 5).alias("weighted"),
        *(F.lit(summary[c]).alias(c) for c in ("status", "vector_count", "dimensions", "documents")),
        F.lit(round(summary["quality"]["self_contained"], 6)).alias("self_contained"),
        F.lit(round(summary["quality"]["mid_word_breaks"], 6)).alias("mid_word_breaks"),
    )


def multi_corpus_union(spark, sf):
    numbered = {name: ordinals.assign_vec_ids(c) for name, c in _corpora(spark, sf).items()}
    return merge.union_corpora(numbered).select("index_id", "vec_id", "text")


# Streaming -----------------------------------------------------------------


def _streamed(spark: SparkSession, sf: str) -> str:
    """Index files that arrive in two lots, with a run after each."""
    source, path = scratch_path(spark, "arriving"), scratch_path(spark, "increments")
    docs = table(spark, sf, "documents").select(
        F.col("doc_id").cast("string").alias("title"), "text", "lang"
    )
    english = F.col("lang") == "en"
    for lot in (english, ~english):
        docs.filter(lot).drop("lang").write.mode("append").json(source)
        incremental.incremental_index(
            spark, source, path, f"{path}/checkpoint", "article", EMBEDDER, line_suffix="json"
        ).awaitTermination()
    return path


def incremental_index(spark, sf):
    numbered = incremental.number_increments(spark, _streamed(spark, sf))
    return numbered.select("title", "chunk", "text")


def incremental_rejects(spark, sf):
    """Lines that the stream set aside, with their reasons."""
    source, path = scratch_path(spark, "arriving"), scratch_path(spark, "increments")
    raw_lines(spark, sf).select("value").write.text(source)
    incremental.incremental_index(
        spark, source, path, f"{path}/checkpoint", "article", EMBEDDER, line_suffix="txt"
    ).awaitTermination()
    return incremental.rejects(spark, path).groupBy("reason").agg(
        F.count(F.lit(1)).alias("records"), F.sum(F.length("value")).alias("chars")
    )


def progress_log(spark, sf):
    log = incremental.progress_log(spark, _streamed(spark, sf))
    return log.agg(
        F.max("vectors_count").alias("vectors_count"),
        F.max("rows_processed").alias("rows_processed"),
        F.sum("rejected").alias("rejected"),
    )


QUERIES = {
    f.__name__: f
    for f in (
        scan_jsonl, scan_parquet, discover_files, row_provenance, file_range_split,
        concat_shards, scan_text_corpus, load_index, source_row_counts,
        write_chunks, write_metadata, write_vector_shards, write_summary,
        artifact_manifest, publish_verified,
        assemble_articles, assemble_qa, assemble_papers_redpajama,
        assemble_papers_standard, clean_latex_corpus, encode_prefix, chunk_metadata,
        drop_empty_documents, drop_short_chunks, quarantine_malformed, filter_by_label,
        chunk_words, chunk_words_overlap, chunk_stats,
        embed_chunks, l2_normalize, inner_product, cosine_similarity,
        vector_validation, vector_precision_cast, embedder_udf,
        align_triple, alignment_audit, result_lookup, score_pairs,
        topk_single, topk_batch, topk_with_sources, topk_filtered, score_bands,
        topk_per_index, topk_block,
        estimate_chunks_by_length, estimate_chunks_by_rows, chunks_per_document,
        corpus_totals, ingest_counts, shard_accounting, estimate_vs_actual,
        integrity_gate, manifest_match, chunk_quality,
        assign_vec_ids, sample_limit, merge_splits, mini_index, multi_corpus_union,
        incremental_index, incremental_rejects, progress_log,
    )
}
