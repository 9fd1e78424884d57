"""Assembling one labelled text per source record.

Every ``*_document`` function is a Column; it is NULL where the record yields
no document.  The ``assemble_*`` functions add that column to a DataFrame.
Sections are separated by a blank line and an absent section leaves no trace.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from corpusvec.functions import text as T
from corpusvec.functions import variants as V

SECTION_BREAK = "\n\n"
DOCUMENT = "document"

# Limits on answers, authors, titles, and section lengths.
MAX_ANSWERS = 3
QUESTION_CHARS, ACCEPTED_CHARS, ANSWER_CHARS = 5000, 3000, 2000
PAPER_CHARS = 5000
MAX_AUTHORS = 5
TITLE_CHARS = 100

# Prefixes the encoder expects before passages and queries.
PREFIXES = {"passage": "passage: ", "query": "query: "}


def _section(label: str, body: Column, gap: str = " ") -> Column:
    """A labelled section; NULL if the body is NULL or empty."""
    return F.when(body != "", F.concat(F.lit(f"[{label}]{gap}"), body))


def _document(*sections: Column) -> Column:
    return T.non_empty(F.concat_ws(SECTION_BREAK, *sections))


# Articles ------------------------------------------------------------------


def article_document(title: Column, text: Column, categories: Column) -> Column:
    body = T.strip(text)
    return F.when(
        body != "",
        _document(
            _section("TITLE", T.strip(title)),
            _section("CATEGORIES", T.join_present(categories)),
            _section("CONTENT", body, "\n"),
        ),
    )


def article_fields(record: Column) -> dict[str, Column]:
    """Typed article columns of a VARIANT record."""
    return {
        "title": V.text_of(V.field(record, "title")),
        "text": V.text_of(V.field(record, "text")),
        "categories": V.display_list(V.field(record, "categories")),
        "is_featured": V.is_truthy(V.field(record, "is_featured")),
    }


def assemble_articles(df: DataFrame) -> DataFrame:
    """Expects ``title``, ``text``, ``categories`` (ARRAY<STRING>)."""
    return df.withColumn(
        DOCUMENT,
        article_document(F.col("title"), F.col("text"), F.col("categories")),
    )


# Questions and answers -----------------------------------------------------


def qa_document(
    tags: Column,
    title: Column,
    question: Column,
    accepted: Column,
    answers: Column,
    max_answers: int = MAX_ANSWERS,
    caps: tuple[int, int, int] = (QUESTION_CHARS, ACCEPTED_CHARS, ANSWER_CHARS),
) -> Column:
    question_cap, accepted_cap, answer_cap = caps
    # The first answers are taken before blank ones are dropped.
    listed = F.transform(
        F.slice(answers, 1, max_answers),
        lambda a: F.when(
            T.strip(a) != "", F.concat(F.lit("- "), T.cap(T.strip(a), answer_cap))
        ),
    )
    return _document(
        _section("TAGS", T.join_present(tags)),
        _section("QUESTION_TITLE", T.strip(title)),
        _section("QUESTION", T.cap(T.strip(question), question_cap), "\n"),
        _section("ACCEPTED_ANSWER", T.cap(T.strip(accepted), accepted_cap), "\n"),
        _section("OTHER_ANSWERS", T.join_present(listed, "\n"), "\n"),
    )


def qa_fields(record: Column) -> dict[str, Column]:
    """Typed Q&A columns of a VARIANT record, with the capitalised aliases.

    Answers keep their places: one that is neither text nor an object is NULL.
    """

    def text(*names: str) -> Column:
        return V.text_of(V.first_truthy(record, *names))

    def answer(item: Column) -> Column:
        return F.when(
            V.is_object(item), V.text_of(V.first_truthy(item, "body", "Body"))
        ).otherwise(V.text_of(item))

    return {
        "tags": V.display_list(V.first_truthy(record, "tags", "Tags")),
        "title": text("title", "Title"),
        "question": text("question", "Question", "body"),
        "accepted_answer": text("accepted_answer", "AcceptedAnswer"),
        "answers": F.transform(
            V.items_of(V.first_truthy(record, "answers", "Answers")), answer
        ),
    }


def assemble_qa(
    df: DataFrame,
    max_answers: int = MAX_ANSWERS,
    caps: tuple[int, int, int] = (QUESTION_CHARS, ACCEPTED_CHARS, ANSWER_CHARS),
) -> DataFrame:
    """Expects ``tags``, ``title``, ``question``, ``accepted_answer``, ``answers``."""
    names = ("tags", "title", "question", "accepted_answer", "answers")
    return df.withColumn(
        DOCUMENT, qa_document(*map(F.col, names), max_answers=max_answers, caps=caps)
    )


# Papers --------------------------------------------------------------------


def redpajama_document(
    text: Column, arxiv_id: Column, yymm: Column, cap: int = PAPER_CHARS
) -> Column:
    return F.when(
        T.strip(text) != "",
        F.concat_ws(
            SECTION_BREAK,
            _section("ARXIV_ID", arxiv_id),
            _section("DATE", yymm),
            # The label stays even if cleaning leaves nothing behind it.
            F.concat(F.lit("[CONTENT]\n"), T.cap(T.clean_latex(text), cap)),
        ),
    )


def standard_document(
    arxiv_id: Column,
    categories: Column,
    title: Column,
    authors: Column,
    abstract: Column,
) -> Column:
    """``categories`` and ``authors`` are the already joined strings."""
    return F.when(
        T.strip(abstract) != "",
        F.concat_ws(
            SECTION_BREAK,
            _section("ARXIV_ID", arxiv_id),
            _section("CATEGORIES", categories),
            F.when(
                T.strip(title) != "",
                F.concat(F.lit("[TITLE] "), T.clean_latex(title)),
            ),
            F.when(
                authors != "", F.concat(F.lit("[AUTHORS] "), T.clean_latex(authors))
            ),
            F.concat(F.lit("[ABSTRACT]\n"), T.clean_latex(abstract)),
        ),
    )


def join_authors(authors: Column, max_authors: int = MAX_AUTHORS) -> Column:
    """The first authors of a list, taken before blank ones are dropped."""
    return T.join_present(F.slice(authors, 1, max_authors))


def is_redpajama(record: Column) -> Column:
    """Both keys present, whatever their values."""
    return ~V.is_missing(V.field(record, "text")) & ~V.is_missing(
        V.field(record, "meta")
    )


def paper_fields(record: Column, max_authors: int = MAX_AUTHORS) -> dict[str, Column]:
    """Typed paper columns of a VARIANT record, for both forms.

    ``arxiv_id`` is the top-level id only; ``meta_id`` is the one under meta.
    """

    def scalar(value: Column) -> Column:
        return F.when(V.is_truthy(value), V.display(value))

    def list_or_scalar(limit: int | None, *names: str) -> Column:
        def printed(value: Column) -> Column:
            items = V.items_of(value)
            if limit is not None:
                items = F.slice(items, 1, limit)
            listed = F.transform(F.filter(items, V.is_truthy), V.display)
            return F.when(V.is_list(value), T.join_present(listed)).otherwise(
                V.display(value)
            )

        return T.bind(V.first_truthy(record, *names), printed)

    meta = V.field(record, "meta")
    return {
        "redpajama": is_redpajama(record),
        "text": V.text_of(V.field(record, "text")),
        "meta_id": scalar(V.field(meta, "arxiv_id")),
        "yymm": scalar(V.field(meta, "yymm")),
        "arxiv_id": V.display(V.first_truthy(record, "id", "arxiv_id")),
        "categories": list_or_scalar(None, "categories", "category"),
        "category_list": T.bind(
            V.first_truthy(record, "categories", "category"),
            lambda v: F.coalesce(V.display_list(v), F.when(v.isNotNull(), F.array(V.display(v)))),
        ),
        "title": V.text_of(V.field(record, "title")),
        "authors": list_or_scalar(max_authors, "authors", "author"),
        "abstract": V.text_of(V.field(record, "abstract")),
    }


def assemble_papers_redpajama(df: DataFrame, cap: int = PAPER_CHARS) -> DataFrame:
    """Expects ``text``, ``meta_id``, ``yymm``."""
    return df.withColumn(
        DOCUMENT,
        redpajama_document(F.col("text"), F.col("meta_id"), F.col("yymm"), cap),
    )


def assemble_papers_standard(df: DataFrame, max_authors: int = MAX_AUTHORS) -> DataFrame:
    """Expects ``arxiv_id``, ``categories``, ``title``, ``authors``, ``abstract``.

    ``categories`` and ``authors`` may be a string or an array of strings.
    """

    def joined(name: str, limit: int | None) -> Column:
        if df.schema[name].dataType.typeName() != "array":
            return F.col(name)
        if limit is None:
            return T.join_present(F.col(name))
        return join_authors(F.col(name), limit)

    return df.withColumn(
        DOCUMENT,
        standard_document(
            F.col("arxiv_id"),
            joined("categories", None),
            F.col("title"),
            joined("authors", max_authors),
            F.col("abstract"),
        ),
    )


def assemble_papers(df: DataFrame, cap: int = PAPER_CHARS) -> DataFrame:
    """Either form, told apart by ``redpajama``; fields as in ``paper_fields``."""
    c = F.col
    return df.withColumn(
        DOCUMENT,
        F.when(
            c("redpajama"),
            redpajama_document(c("text"), c("meta_id"), c("yymm"), cap),
        ).otherwise(
            standard_document(
                c("arxiv_id"), c("categories"), c("title"), c("authors"), c("abstract")
            )
        ),
    )


# Shared --------------------------------------------------------------------


def encode_prefix(
    df: DataFrame, kind: str, text: str = "text", out: str = "encoder_input"
) -> DataFrame:
    """The encoder's input: the stored text behind its role prefix."""
    return df.withColumn(out, F.concat(F.lit(PREFIXES[kind]), F.col(text)))


def chunk_metadata(df: DataFrame, title_chars: int = TITLE_CHARS) -> DataFrame:
    """Provenance columns of a chunk; the paper id only where there is one."""
    columns = [
        F.col("source"),
        F.col("file_index").cast("int").alias("file_index"),
        F.col("row").cast("long").alias("row"),
        F.col("chunk").cast("int").alias("chunk"),
        F.left(F.coalesce(F.col("title"), F.lit("")), F.lit(title_chars)).alias("title"),
    ]
    if "arxiv_id" in df.columns:
        columns.append(F.coalesce(F.col("arxiv_id"), F.lit("")).alias("arxiv_id"))
    if "vec_id" in df.columns:
        columns.insert(0, F.col("vec_id"))
    return df.select(*columns)


def drop_empty_documents(df: DataFrame, document: str = DOCUMENT) -> DataFrame:
    return df.filter(F.col(document).isNotNull() & (T.strip(F.col(document)) != ""))


def filter_by_label(df: DataFrame, column: str, values: list | bool) -> DataFrame:
    """Rows whose flag is set, whose value is listed, or whose list has a listed value."""
    if isinstance(values, bool):
        return df.filter(F.col(column) == values)
    if df.schema[column].dataType.typeName() == "array":
        return df.filter(F.arrays_overlap(F.col(column), F.array(*map(F.lit, values))))
    return df.filter(F.col(column).isin(values))
