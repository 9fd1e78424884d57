"""The same results in DuckDB SQL, over the same whole tables."""

from __future__ import annotations

WS = r"[\x{9}-\x{d}\x{1c}-\x{20}\x{85}\x{a0}\x{1680}\x{2000}-\x{200a}\x{2028}\x{2029}\x{202f}\x{205f}\x{3000}]"
DIM = 64


def strip(x: str) -> str:
    return f"regexp_replace(regexp_replace({x}, '^{WS}+', ''), '{WS}+$', '')"


def squeeze(x: str) -> str:
    return f"trim(regexp_replace({x}, '{WS}+', ' ', 'g'))"


def first_line(x: str) -> str:
    return f"left(split_part({x}, chr(10), 1), 60)"


def latex(x: str) -> str:
    return (
        rf"('\section{{Intro}} \emph{{' || split_part({x}, ' ', 1) || "
        rf"'}} \cite{{ref}} costs \$5, $$x_1$$ and \alpha\beta{{}} ' || {x} || ' \textbf{{end}}')"
    )


def clean(x: str) -> str:
    for old, new in (
        (r"\emph{", ""), (r"\textbf{", ""), (r"\textit{", ""), (r"\cite{", "["),
        (r"\ref{", "["), ("}", ""), (r"\$", ""), ("$$", ""),
    ):
        x = f"replace({x}, '{old}', '{new}')"
    return squeeze(rf"regexp_replace({x}, '\\[a-zA-Z]+', ' ', 'g')")


def cap(x: str, n: int) -> str:
    return f"CASE WHEN length({x}) > {n} THEN left({x}, {n}) || '...' ELSE {x} END"


def section(label: str, x: str, gap: str = "' '") -> str:
    return f"CASE WHEN {x} <> '' THEN '[{label}]' || {gap} || {x} END"


NL = "chr(10)"
BREAK = "chr(10) || chr(10)"

PLAIN = f"""
    SELECT doc_id, source, lang, (doc_id % 75)::INT AS file_index, doc_id // 75 AS row,
           {first_line('text')} AS title, text AS document
    FROM documents"""

ARTICLES = f"""
    SELECT doc_id, source, (doc_id % 75)::INT AS file_index, doc_id // 75 AS row, title,
           CASE WHEN {strip('text')} <> '' THEN concat_ws({BREAK},
               {section('TITLE', strip('title'))},
               '[CATEGORIES] ' || lang || ', ' || source,
               '[CONTENT]' || {NL} || {strip('text')}) END AS document
    FROM (SELECT *, {first_line('text')} AS title FROM documents)"""

def qa(question_cap: int, accepted_cap: int, answer_cap: int) -> str:
    return f"""
    SELECT conv_id, 'conversations' AS source, 0 AS file_index, conv_id AS row, title,
           concat_ws({BREAK},
               {section('TAGS', 'tags')},
               {section('QUESTION_TITLE', strip('title'))},
               {section('QUESTION', cap(strip('question'), question_cap), NL)},
               {section('ACCEPTED_ANSWER', cap(strip('accepted'), accepted_cap), NL)},
               {section('OTHER_ANSWERS', 'others', NL)}) AS document
    FROM (
        SELECT conv_id, tags, question, {first_line('question')} AS title, replies[1] AS accepted,
               array_to_string(list_transform(list_filter(replies[2:4], lambda a: {strip('a')} <> ''),
                   lambda a: '- ' || {cap(strip('a'), answer_cap)}), {NL}) AS others
        FROM (
            SELECT conv_id, max(CASE WHEN turn = 0 THEN text END) AS question,
                   array_to_string(list_sort(list_distinct(list(role))), ', ') AS tags,
                   list(text ORDER BY turn) FILTER (role = 'assistant') AS replies
            FROM conversations GROUP BY conv_id))"""


QA = qa(200, 150, 100)
QA_WHOLE = qa(5000, 3000, 2000)


def chunk_ctes(source: str, carried: str = "", lim: int = 1500, first: int = 1499) -> str:
    """CTEs ending in ``chunks``: greedy packing, one chunk per step.

    What is left of a text loses its longest fitting prefix that ends at a word.
    """
    carried = f", {carried}" if carried else ""
    return f"""
    src AS ({source}),
    step AS (
        SELECT doc_id{carried}, -1 AS chunk, '' AS text, {squeeze('document')} AS rest
        FROM src WHERE length(document) > {lim}
        UNION ALL
        SELECT doc_id{carried}, chunk + 1, left(rest, take), substr(rest, take + 2)
        FROM (
            SELECT *, CASE
                WHEN length(rest) <= room THEN length(rest)
                WHEN contains(left(rest, room + 1), ' ')
                    THEN room + 1 - instr(reverse(left(rest, room + 1)), ' ')
                WHEN contains(rest, ' ') THEN instr(rest, ' ') - 1
                ELSE length(rest) END AS take
            FROM (SELECT *, CASE WHEN chunk = -1 THEN {first} ELSE {lim} END AS room FROM step)
            WHERE rest <> '')),
    chunks AS (
        SELECT doc_id{carried}, 0 AS chunk, document AS text FROM src WHERE length(document) <= {lim}
        UNION ALL
        SELECT doc_id{carried}, chunk, text FROM step WHERE chunk >= 0)"""


OVERLAP = f"""
    src AS (SELECT doc_id, {squeeze('text')} AS document FROM documents),
    step AS (
        SELECT doc_id, -1 AS chunk, '' AS text, document AS rest FROM src
        UNION ALL
        SELECT doc_id, chunk + 1, left(rest, take),
               CASE WHEN substr(rest, take + 2) = '' THEN '' ELSE
                    CASE WHEN contains(tail, ' ') THEN substr(tail, instr(tail, ' ') + 1) || ' '
                         ELSE '' END || substr(rest, take + 2) END
        FROM (
            SELECT *, right(left(rest, take), 201) AS tail
            FROM (
                SELECT *, CASE
                    WHEN length(rest) <= 1500 THEN length(rest)
                    WHEN contains(left(rest, 1501), ' ')
                        THEN 1501 - instr(reverse(left(rest, 1501)), ' ')
                    WHEN contains(rest, ' ') THEN instr(rest, ' ') - 1
                    ELSE length(rest) END AS take
                FROM step WHERE rest <> '' OR chunk = -1))),
    chunks AS (SELECT doc_id, chunk, text FROM step WHERE chunk >= 0)"""

CARRIED = "source, file_index, row, title"

def numbered_ctes(source: str) -> str:
    """Kept chunks of the documents of a source, numbered."""
    return f"""{chunk_ctes(source, CARRIED)},
    kept AS (SELECT * FROM chunks WHERE length({strip('text')}) >= 20),
    numbered AS (
        SELECT row_number() OVER (ORDER BY file_index, row, chunk) - 1 AS vec_id, *
        FROM kept)"""


NUMBERED = numbered_ctes(PLAIN)


def hashed(name: str, source: str, key: str) -> str:
    """A CTE of unit vectors (key, list) for prefixed texts (key, input)."""
    return f"""
    {name}_sums AS (
        SELECT {key}, ('0x' || substr(md5(w), 1, 6))::BIGINT % {DIM} AS b,
               sum(1 - 2 * (('0x' || substr(md5(w), 7, 1))::BIGINT % 2))::DOUBLE AS s
        FROM (SELECT {key}, unnest(string_split({squeeze('lower(input)')}, ' ')) AS w FROM ({source}))
        GROUP BY 1, 2),
    {name}_dense AS (
        SELECT k.{key}, d.b, coalesce(s, 0) AS s
        FROM (SELECT DISTINCT {key} FROM {name}_sums) k CROSS JOIN (SELECT range AS b FROM range({DIM})) d
        LEFT JOIN {name}_sums USING ({key}, b)),
    {name} AS (
        SELECT {key}, list(CASE WHEN norm = 0 THEN 0 ELSE s / norm END::FLOAT ORDER BY b)::DOUBLE[] AS v
        FROM {name}_dense JOIN (SELECT {key}, sqrt(sum(s * s)) AS norm FROM {name}_dense GROUP BY 1)
        USING ({key}) GROUP BY 1)"""


def text_vectors(numbered: str) -> str:
    return f"""{numbered},
    {hashed('index_vectors', "SELECT vec_id, 'passage: ' || text AS input FROM numbered", 'vec_id')}"""


def text_search(numbered: str, where: str = "true") -> str:
    return f"""{text_vectors(numbered)},
    {hashed('query_vectors', "SELECT item_id AS query_id, 'query: ' || text AS input FROM benchmark", 'query_id')},
    ranked AS (
        SELECT *, row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id) AS rank
        FROM (SELECT query_id, vec_id, round(list_inner_product(q.v, i.v), 9) AS score
              FROM query_vectors q CROSS JOIN (SELECT i.* FROM index_vectors i JOIN numbered USING (vec_id)
                                               WHERE {where}) i))"""


TEXT_VECTORS = text_vectors(NUMBERED)
TEXT_SEARCH = text_search(NUMBERED)

TWENTIETH = """
    queries AS (
        SELECT vec_id AS query_id, embedding::DOUBLE[] AS q FROM embeddings WHERE vec_id % 20 = 0)"""
SCORED = f"""{TWENTIETH},
    scored AS (
        SELECT query_id, vec_id, label, round(list_inner_product(q, embedding::DOUBLE[]), 9) AS score
        FROM queries CROSS JOIN embeddings)"""


def best(k: int, where: str = "true", group: str = "query_id") -> str:
    return f"""
    hits AS (
        SELECT query_id, vec_id, label, score, rank FROM (
            SELECT *, row_number() OVER (PARTITION BY {group} ORDER BY score DESC, vec_id) AS rank
            FROM scored WHERE {where})
        WHERE rank <= {k})"""


WEIGHTED = "list_sum(list_transform(v, lambda x, i: x * i))"
ENGLISH_SRC3 = "source = 'src3' AND (SELECT lang FROM documents d WHERE d.doc_id = numbered.doc_id) = 'en'"

SCALED = "list_transform(embedding, lambda x: x::DOUBLE * (label + 1))"


def long_form(key: str, source: str, decimals: int = 6) -> str:
    """(key, dim, value) of a relation (key, v)."""
    return f"""
    SELECT {key}, (unnest(range(len(v))))::INT AS dim, round(unnest(v), {decimals}) + 0.0 AS value
    FROM ({source})"""


def papers_document(form: str) -> str:
    if form == "redpajama":
        body = cap(clean(latex("text")), 5000)
        return f"""
    SELECT doc_id, concat_ws({BREAK}, '[ARXIV_ID] p' || doc_id,
        '[DATE] ' || right('0000' || (doc_id % 10000), 4), '[CONTENT]' || {NL} || {body}) AS document
    FROM documents"""
    title = first_line("text")
    authors = f"array_to_string(string_split({squeeze('text')}, ' ')[1:5], ', ')"
    return f"""
    SELECT doc_id, concat_ws({BREAK}, '[ARXIV_ID] p' || doc_id, '[CATEGORIES] ' || lang || ', ' || source,
        CASE WHEN {strip(title)} <> '' THEN '[TITLE] ' || {clean(title)} END,
        CASE WHEN {authors} <> '' THEN '[AUTHORS] ' || {clean(authors)} END,
        '[ABSTRACT]' || {NL} || {clean(latex('text'))}) AS document
    FROM documents"""


RAW_ARTICLES = f"""
    SELECT doc_id, source, lang = 'de' AS malformed,
           CASE WHEN lang NOT IN ('de', 'es') AND {strip('text')} <> '' THEN
               concat_ws({BREAK}, CASE WHEN lang <> 'fr' THEN '[TITLE] t' END,
                   '[CONTENT]' || {NL} || {strip('text')}) END AS document
    FROM documents"""

KEPT_DOCUMENTS = f"{strip('document')} <> ''"
LONG_ENOUGH = f"length({strip('text')}) >= 20"

CORPORA = f"""{chunk_ctes(f'''
        SELECT 'articles' AS index_id, doc_id, file_index, row, document FROM ({ARTICLES})
        UNION ALL
        SELECT 'questions', conv_id, file_index, row, document FROM ({QA_WHOLE}) WHERE document <> \'\'
    ''', 'index_id, file_index, row')},
    kept AS (SELECT * FROM chunks WHERE {LONG_ENOUGH})"""

ORACLES = {
    # sources
    "scan_jsonl": "SELECT row_number() OVER (ORDER BY doc_id) - 1 AS position, doc_id, lang, text FROM documents",
    "scan_parquet": "SELECT doc_id, lang, n_chars FROM documents",
    "discover_files": """
        SELECT 'json' AS kind, 3::BIGINT AS files, count(*) AS rows, 0::BIGINT AS outside FROM documents
        UNION ALL SELECT 'parquet', 2, count(*), 0 FROM benchmark""",
    "row_provenance": """
        SELECT doc_id, 'documents.parquet' AS source, row_number() OVER (ORDER BY doc_id) - 1 AS row
        FROM documents""",
    "file_range_split": """
        SELECT doc_id, (doc_id % 75)::INT AS file_index, ((doc_id % 75) // 15)::INT AS split_id
        FROM documents""",
    "concat_shards": """
        SELECT lang AS shard, count(*) AS lines, sum(length(text))::BIGINT AS chars
        FROM documents GROUP BY ROLLUP (lang)""",
    "scan_text_corpus": f"SELECT 'txt' AS suffix, {strip('text')} AS text FROM benchmark",
    "load_index": f"""
        WITH RECURSIVE {NUMBERED}
        SELECT vec_id, doc_id, source, lang, file_index, row, chunk, title
        FROM numbered JOIN (SELECT doc_id, lang FROM documents) USING (doc_id)""",
    "source_row_counts": "SELECT 'documents.parquet' AS source, count(*) AS rows FROM documents",
    # sinks
    "write_chunks": f"WITH RECURSIVE {NUMBERED} SELECT vec_id AS position, text FROM numbered",
    "write_metadata": f"""
        WITH RECURSIVE {NUMBERED}
        SELECT vec_id AS position, source, file_index, row, chunk, title FROM numbered""",
    "write_vector_shards": """
        SELECT (vec_id // 200)::INT AS shard_id, count(*) AS vectors, min(vec_id) AS first_id,
               max(vec_id) AS last_id,
               round(sum(list_sum(list_transform(embedding, lambda x, i: x::DOUBLE * i))), 4) AS weighted,
               0::BIGINT AS disordered, least(count(*), 50) - 1 AS last_row
        FROM embeddings GROUP BY 1""",
    "write_summary": f"""
        SELECT dataset_name, count(*) AS total_vectors, 'signed word hashing' AS embedding_model,
               {DIM}::BIGINT AS embedding_dimension,
               CASE WHEN dataset_name = 'whole' OR (count(*) = (SELECT count(*) FROM documents)
                         AND count(*) = (SELECT count(*) FROM labels)) THEN 'VERIFIED' ELSE 'UNVERIFIED' END
                   AS integrity_status
        FROM embeddings, (VALUES ('whole'), ('torn')) t(dataset_name) GROUP BY 1""",
    "artifact_manifest": """
        SELECT 'texts' AS artifact, strlen(text) + 1 AS bytes, sha256(text || chr(10)) AS sha256
        FROM benchmark""",
    "publish_verified": """
        SELECT 'embeddings' AS dataset_name, count(*) AS total_vectors, 'VERIFIED' AS integrity_status
        FROM embeddings""",
    # assembly and filters
    "assemble_articles": f"SELECT doc_id, document FROM ({ARTICLES})",
    "assemble_qa": f"SELECT conv_id, document FROM ({QA})",
    "assemble_papers_redpajama": papers_document("redpajama"),
    "assemble_papers_standard": papers_document("standard"),
    "clean_latex_corpus": f"SELECT doc_id, {clean(latex('text'))} AS cleaned FROM documents",
    "encode_prefix": """
        SELECT 'passage' AS kind, doc_id AS id, 'passage: ' || text AS encoder_input FROM documents
        UNION ALL SELECT 'query', item_id, 'query: ' || text FROM benchmark""",
    "chunk_metadata": f"""
        WITH RECURSIVE {NUMBERED} SELECT source, file_index, row, chunk, title FROM numbered""",
    "drop_empty_documents": "SELECT doc_id FROM documents WHERE length(text) >= 20",
    "drop_short_chunks": f"""
        WITH RECURSIVE {chunk_ctes(PLAIN)}
        SELECT doc_id, chunk FROM chunks WHERE {LONG_ENOUGH}""",
    "quarantine_malformed": """
        SELECT doc_id, CASE lang WHEN 'de' THEN 'malformed JSON' WHEN 'es' THEN 'not an object'
                                 WHEN 'fr' THEN 'ill-typed title' ELSE 'kept' END AS reason
        FROM documents""",
    "filter_by_label": "SELECT doc_id FROM documents WHERE lang = 'fr' OR source = 'src3'",
    # chunks
    "chunk_words": f"WITH RECURSIVE {chunk_ctes(PLAIN)} SELECT doc_id, chunk, text FROM chunks",
    "chunk_words_overlap": f"WITH RECURSIVE {OVERLAP} SELECT doc_id, chunk, text FROM chunks",
    "chunk_stats": f"""
        WITH RECURSIVE {OVERLAP}
        SELECT doc_id || '__chunk_' || lpad(chunk::VARCHAR, 3, '0') AS chunk_id, doc_id,
               chunk AS chunk_index, count(*) OVER (PARTITION BY doc_id) AS chunk_count,
               length(text) AS char_count,
               CASE WHEN text = '' THEN 0 ELSE len(string_split(text, ' ')) END AS word_count
        FROM chunks""",
    # vectors
    "embed_chunks": f"""
        WITH RECURSIVE {TEXT_VECTORS} {long_form('vec_id', 'SELECT vec_id, v FROM index_vectors')}""",
    "l2_normalize": long_form(
        "vec_id",
        f"""SELECT vec_id, list_transform(e, lambda x: x / n) AS v
            FROM (SELECT vec_id, {SCALED} AS e,
                         sqrt(list_inner_product({SCALED}, {SCALED})) AS n FROM embeddings)""",
    ),
    "inner_product": f"""
        WITH {TWENTIETH}
        SELECT vec_id, round(list_inner_product({SCALED}, q), 6) + 0.0 AS score
        FROM embeddings JOIN queries ON vec_id - vec_id % 20 = query_id""",
    "cosine_similarity": f"""
        WITH {TWENTIETH}
        SELECT vec_id, round(list_cosine_similarity({SCALED}, q), 6) + 0.0 AS score
        FROM embeddings JOIN queries ON vec_id - vec_id % 20 = query_id""",
    "vector_validation": f"""
        SELECT *, null_vectors = 0 AND wrong_norms = 0 AND min_dim = {DIM} AND max_dim = {DIM} AS valid
        FROM (SELECT count(*) AS vectors, count(*) - count(embedding) AS null_vectors,
                     count(*) FILTER (list_inner_product(embedding::DOUBLE[], embedding::DOUBLE[]) = 0) AS zero_vectors,
                     count(*) FILTER (list_inner_product(embedding::DOUBLE[], embedding::DOUBLE[]) <> 0 AND
                         abs(sqrt(list_inner_product(embedding::DOUBLE[], embedding::DOUBLE[])) - 1) > 1e-3) AS wrong_norms,
                     min(len(embedding)) AS min_dim, max(len(embedding)) AS max_dim,
                     round(sqrt(min(list_inner_product(embedding::DOUBLE[], embedding::DOUBLE[]))), 4) AS min_norm,
                     round(sqrt(max(list_inner_product(embedding::DOUBLE[], embedding::DOUBLE[]))), 4) AS max_norm
              FROM embeddings)""",
    "vector_precision_cast": long_form(
        "vec_id",
        f"SELECT vec_id, list_transform({SCALED}, lambda x: (x * 0.1::DOUBLE)::FLOAT)::DOUBLE[] AS v FROM embeddings",
        9,
    ),
    "embedder_udf": long_form(
        "doc_id",
        """SELECT doc_id, list_transform(c, lambda x: CASE WHEN n = 0 THEN 0 ELSE x / n END::FLOAT)::DOUBLE[] AS v
           FROM (SELECT doc_id, c, sqrt(list_inner_product(c, c)) AS n
                 FROM (SELECT doc_id, list_transform(range(26),
                              lambda i: (length(text) - length(replace(text, chr((97 + i)::INT), '')))::DOUBLE) AS c
                       FROM documents))""",
    ),
    # joins
    "align_triple": """
        SELECT vec_id, label, text, quality FROM embeddings
        JOIN (SELECT doc_id AS vec_id, text FROM documents) USING (vec_id)
        JOIN (SELECT doc_id AS vec_id, quality FROM labels) USING (vec_id)""",
    "alignment_audit": """
        SELECT * FROM (
            SELECT vec_id, count(*) FILTER (part = 1) AS in_vectors, count(*) FILTER (part = 2) AS in_chunks,
                   count(*) FILTER (part = 3) AS in_metadata
            FROM (SELECT vec_id, 1 AS part FROM embeddings UNION ALL SELECT doc_id, 2 FROM documents
                  UNION ALL SELECT doc_id, 3 FROM labels) GROUP BY vec_id)
        WHERE NOT (in_vectors = 1 AND in_chunks = 1 AND in_metadata = 1)""",
    "result_lookup": f"""
        WITH {SCORED}, {best(10)}
        SELECT vec_id, lang, n_chars, query_id, round(score, 6) + 0.0 AS score, rank
        FROM hits LEFT JOIN documents ON vec_id = doc_id""",
    "score_pairs": f"""
        WITH {SCORED}
        SELECT p.query_id, p.vec_id, round(score, 6) + 0.0 AS score
        FROM (SELECT vec_id, vec_id - vec_id % 20 + unnest([0, 20]) AS query_id FROM embeddings) p
        LEFT JOIN scored s ON s.query_id = p.query_id AND s.vec_id = p.vec_id""",
    # search
    "topk_single": """
        SELECT vec_id, round(score, 6) + 0.0 AS score, rank FROM (
            SELECT *, row_number() OVER (ORDER BY score DESC, vec_id) AS rank FROM (
                SELECT vec_id, round(list_inner_product(embedding::DOUBLE[],
                    (SELECT arg_min(embedding, vec_id) FROM embeddings)::DOUBLE[]), 9) AS score
                FROM embeddings))
        WHERE rank <= 10""",
    "topk_batch": f"""
        WITH {SCORED}, {best(10)}
        SELECT query_id, vec_id, round(score, 6) + 0.0 AS score, rank FROM hits""",
    "topk_with_sources": f"""
        WITH RECURSIVE {TEXT_SEARCH}
        SELECT query_id, rank, round(score, 6) + 0.0 AS score, vec_id,
               replace(left(text, 100), chr(10), ' ') AS preview, source, file_index, row, chunk
        FROM ranked JOIN numbered USING (vec_id) WHERE rank <= 3""",
    "topk_filtered": f"""
        WITH RECURSIVE {text_search(numbered_ctes(ARTICLES), ENGLISH_SRC3)}
        SELECT query_id, vec_id, round(score, 6) + 0.0 AS score, rank FROM ranked WHERE rank <= 10""",
    "score_bands": f"""
        WITH {SCORED}, {best(10)}
        SELECT CASE WHEN score >= 0.9 THEN 'near-identical' WHEN score >= 0.8 THEN 'strongly related'
                    WHEN score >= 0.7 THEN 'topically related' ELSE 'weak' END AS band, count(*) AS hits
        FROM hits GROUP BY 1""",
    "topk_per_index": f"""
        WITH {SCORED}, {best(5, group='label, query_id')}
        SELECT query_id, vec_id, round(score, 6) + 0.0 AS score, label::VARCHAR AS index_id, rank FROM hits""",
    "topk_block": f"""
        WITH RECURSIVE {TEXT_SEARCH}
        SELECT query_id, vec_id, round(score, 6) + 0.0 AS score, rank FROM ranked WHERE rank <= 10""",
    # counts and gates
    "estimate_chunks_by_length": f"""
        SELECT source, count(*) AS documents, sum(greatest(1, length(document) // 1500))::BIGINT AS estimated_chunks
        FROM ({ARTICLES}) WHERE document IS NOT NULL GROUP BY 1""",
    "estimate_chunks_by_rows": """
        SELECT source, count(*) AS rows, floor(count(*) * 1.5)::BIGINT AS estimated_chunks
        FROM documents GROUP BY 1""",
    "chunks_per_document": f"""
        WITH RECURSIVE {NUMBERED}
        SELECT source, count(DISTINCT doc_id) AS documents, count(*) AS chunks,
               round(count(*) / count(DISTINCT doc_id), 6) AS chunks_per_document
        FROM numbered GROUP BY 1""",
    "corpus_totals": f"""
        WITH RECURSIVE {CORPORA}
        SELECT index_id, count(*) AS vectors FROM kept GROUP BY ROLLUP (index_id)""",
    "ingest_counts": f"""
        WITH RECURSIVE {chunk_ctes(f"SELECT * FROM ({RAW_ARTICLES}) WHERE document IS NOT NULL", "source")}
        SELECT d.*, coalesce(c.chunks, 0) AS chunks, coalesce(c.dropped_short, 0) AS dropped_short
        FROM (SELECT source, count(*) AS rows, count(*) FILTER (malformed) AS malformed,
                     count(*) FILTER (document IS NULL AND NOT malformed) AS skipped_empty
              FROM ({RAW_ARTICLES}) GROUP BY 1) d
        LEFT JOIN (SELECT source, count(*) FILTER ({LONG_ENOUGH}) AS chunks,
                          count(*) FILTER (NOT {LONG_ENOUGH}) AS dropped_short
                   FROM chunks GROUP BY 1) c USING (source)""",
    "shard_accounting": f"""
        WITH RECURSIVE {NUMBERED}
        SELECT (vec_id // 500)::INT AS shard_id, count(*) AS vectors, count(*) = 500 AS full
        FROM numbered GROUP BY 1""",
    "estimate_vs_actual": f"""
        WITH RECURSIVE {NUMBERED}
        SELECT source, estimated_chunks, actual_chunks, estimated_chunks - actual_chunks AS difference
        FROM (SELECT source, sum(greatest(1, length(text) // 1500))::BIGINT AS estimated_chunks
              FROM documents GROUP BY 1)
        JOIN (SELECT source, count(*) AS actual_chunks FROM numbered GROUP BY 1) USING (source)""",
    "integrity_gate": f"""
        WITH RECURSIVE {NUMBERED}
        SELECT n_vectors, n_chunks, n_vectors AS n_metadata, n_vectors AS n_expected,
               CASE WHEN n_chunks = n_vectors THEN 'PASSED' ELSE 'FAILED' END AS status
        FROM (SELECT (SELECT count(*) FROM numbered) AS n_vectors, (SELECT count(*) FROM numbered) AS n_chunks
              UNION ALL SELECT (SELECT count(*) FROM numbered), (SELECT count(*) FROM chunks))""",
    "manifest_match": """
        SELECT *, n_vectors = n_chunks AS chunks_match, n_vectors = n_declared AS manifest_matches,
               n_vectors = n_metadata AS metadata_match
        FROM (SELECT (SELECT count(*) FROM embeddings) AS n_vectors,
                     (SELECT count(*) FROM documents) AS n_chunks,
                     (SELECT count(*) FROM labels) AS n_metadata,
                     (SELECT count(*) FROM embeddings) AS n_declared)""",
    "chunk_quality": f"""
        WITH RECURSIVE {chunk_ctes(PLAIN)}
        SELECT *, mid_word_breaks < 0.02 AND self_contained > 0.95 AS passed FROM (
            SELECT count(*) AS chunks, round(avg((NOT clean)::INT), 6) AS mid_word_breaks,
                   round(avg((clean AND long_enough)::INT), 6) AS self_contained
            FROM (SELECT (start = 0 OR substr(whole, start, 1) = ' ')
                         AND (start + length(text) = length(whole) OR substr(whole, start + length(text) + 1, 1) = ' ')
                             AS clean,
                         length({squeeze('text')}) >= 20 AS long_enough
                  FROM (SELECT text, CASE WHEN length(document) > 1500 THEN {squeeze('document')} ELSE document END AS whole,
                               coalesce(sum(length(text) + 1) OVER (
                                   PARTITION BY doc_id ORDER BY chunk ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING
                               ), 0)::BIGINT AS start
                        FROM chunks JOIN src USING (doc_id))))""",
    # ordinals and merging
    "assign_vec_ids": f"WITH RECURSIVE {NUMBERED} SELECT vec_id, doc_id, chunk FROM numbered",
    "sample_limit": f"""
        WITH RECURSIVE {NUMBERED}
        SELECT vec_id, doc_id, chunk FROM numbered ORDER BY vec_id LIMIT 150""",
    "merge_splits": f"""
        WITH RECURSIVE {TEXT_VECTORS}
        SELECT row_number() OVER (ORDER BY file_index // 15, file_index, row, chunk) - 1 AS vec_id,
               (file_index // 15 + (file_index >= 30)::INT)::INT AS split_id, doc_id, chunk,
               round({WEIGHTED}, 5) AS weighted, true AS split_merge, 5::BIGINT AS num_splits,
               count(*) OVER () AS total_vectors
        FROM numbered JOIN index_vectors USING (vec_id)""",
    "mini_index": f"""
        WITH RECURSIVE {OVERLAP},
        numbered AS (SELECT row_number() OVER () AS vec_id, * FROM chunks WHERE text <> ''),
        {hashed('index_vectors', "SELECT vec_id, 'passage: ' || text AS input FROM numbered", 'vec_id')}
        SELECT text, chunk AS chunk_index, count(*) OVER (PARTITION BY doc_id) AS chunk_count,
               length(text) AS char_count, len(string_split(text, ' ')) AS word_count, true AS named,
               round({WEIGHTED}, 5) AS weighted, 'VERIFIED' AS status, count(*) OVER () AS vector_count,
               {DIM} AS dimensions, (SELECT count(DISTINCT doc_id) FROM numbered) AS documents,
               round((SELECT avg((length(text) >= 20)::INT) FROM numbered), 6) AS self_contained,
               0.0 AS mid_word_breaks
        FROM numbered JOIN index_vectors USING (vec_id)""",
    "multi_corpus_union": f"""
        WITH RECURSIVE {CORPORA}
        SELECT index_id, row_number() OVER (PARTITION BY index_id ORDER BY file_index, row, chunk) - 1 AS vec_id,
               text
        FROM kept""",
    # streaming
    "incremental_index": f"""
        WITH RECURSIVE {chunk_ctes(f'''SELECT doc_id,
            '[TITLE] ' || doc_id || {BREAK} || '[CONTENT]' || {NL} || {strip('text')} AS document
            FROM documents WHERE {strip('text')} <> \'\'''')}
        SELECT doc_id::VARCHAR AS title, chunk, text FROM chunks WHERE {LONG_ENOUGH}""",
    "incremental_rejects": f"""
        SELECT reason, count(*) AS records, sum(chars)::BIGINT AS chars FROM (
            SELECT CASE lang WHEN 'de' THEN 'malformed JSON' WHEN 'es' THEN 'not an object'
                             WHEN 'fr' THEN 'ill-typed title' END AS reason,
                   length(to_json({{title: CASE WHEN lang <> 'fr' THEN 't' END, text: text}})::VARCHAR)
                       + CASE lang WHEN 'de' THEN -1 WHEN 'es' THEN 2 ELSE 0 END AS chars
            FROM documents WHERE lang <> 'en')
        WHERE reason IS NOT NULL GROUP BY 1""",
    "progress_log": f"""
        WITH RECURSIVE {chunk_ctes(f'''SELECT doc_id,
            '[TITLE] ' || doc_id || {BREAK} || '[CONTENT]' || {NL} || {strip('text')} AS document
            FROM documents WHERE {strip('text')} <> \'\'''')}
        SELECT (SELECT count(*) FROM chunks WHERE {LONG_ENOUGH}) AS vectors_count,
               (SELECT count(*) FROM documents) AS rows_processed, 0 AS rejected""",
}
