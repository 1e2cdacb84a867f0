"""One registered query for each operator of this subpackage, in the columns its contract names."""

from __future__ import annotations

import uuid

import public_tokenizers
from pyspark.sql import functions as F

from barflow.llm.ann import nearest
from barflow.llm.byte_bpe import Vocabulary, encode
from barflow.llm.chunk_bpe import encode_chunks
from barflow.llm.collocations import collocations
from barflow.llm.exact_dedup import exact_dedup, scratch_index
from barflow.llm.html_extract import extract
from barflow.llm.minhash import near_duplicates
from barflow.llm.mixing import mix_sources
from barflow.llm.prefix_trie import number_turns, prefix_trie, rebuild
from barflow.llm.pseudonyms import pseudonymise
from barflow.llm.range_coder import read_ids, write_ids
from barflow.llm.registry import LLM_ORACLES, LLM_QUERIES, query, table
from barflow.llm.token_counts import Rollup, count_tokens, revised, signed, tokenizer_version, with_version
from barflow.llm.toxicity import grade, train
from barflow.session import materialize, shared_dir

__all__ = ["LLM_ORACLES", "LLM_QUERIES"]

RANKS = public_tokenizers.path("byte_bpe_50k.tiktoken")
MANY_LANGUAGES = public_tokenizers.path("byte_bpe_multi_50k.tiktoken")
#: Key of the registered query alone; real runs bring their own.
SHOWN_KEY = b"registered query"


def digest_ids(encoded, ids="ids", decoded="decoded"):
    """Digest columns of encoded and decoded documents."""
    return encoded.select(
        "doc_id",
        F.size(ids).cast("bigint").alias("n_tokens"),
        F.sha2(F.concat_ws(" ", F.col(ids).cast("array<string>")).cast("binary"), 256).alias("ids_sha256"),
        F.sha2(F.col(decoded), 256).alias("decoded_sha256"),
    )


@query("op1_pseudonyms")
def op1(spark, folder):
    return pseudonymise(table(spark, folder, "documents").select("doc_id", "text"), SHOWN_KEY)


@query("op2_html_extract")
def op2(spark, folder):
    texts = extract(table(spark, folder, "pages").select("page_id", "url", "html"))
    return texts.withColumn("n_chars", F.length("text").cast("bigint"))


@query("op3_byte_bpe")
def op3(spark, folder):
    vocabulary = Vocabulary.from_ranks(RANKS, public_tokenizers.PATTERN)
    docs = table(spark, folder, "documents").select("doc_id", "text")
    return digest_ids(encode(docs, vocabulary, decoded="decoded"))


@query(
    "op4_exact_dedup",
    """
    SELECT doc_id, max(doc_id) OVER same AS keep_id, count(*) OVER same AS group_size,
           doc_id = max(doc_id) OVER same AS kept, sha256(coalesce(text, '')) AS text_sha256
    FROM documents WINDOW same AS (PARTITION BY coalesce(text, ''))
    """,
)
def op4(spark, folder):
    docs = table(spark, folder, "documents").select("doc_id", "text")
    marked = exact_dedup(docs, scratch_index(spark), batch="all")
    return marked.select("doc_id", "keep_id", "group_size", "kept", "text_sha256")


@query(
    "op5_mix_sources",
    r"""
    WITH sized AS (
        SELECT doc_id, source, CAST(len(regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+')) AS BIGINT) AS size
        FROM documents
    ), sources AS (
        SELECT source, CAST(sum(size) AS BIGINT) AS source_size FROM sized GROUP BY source
    ), weighted AS (
        SELECT *, [5.0::DOUBLE, 2.0, 1.0][1 + (row_number() OVER (ORDER BY source NULLS LAST) - 1) % 3] AS weight
        FROM sources
    ), limits AS (
        SELECT *, 2.0::DOUBLE * source_size AS cap, 2.0::DOUBLE * source_size / weight AS full_at,
               sum(source_size) OVER () * 1.5::DOUBLE AS total, sum(weight) OVER () AS weights
        FROM weighted
    ), levels AS (
        SELECT *, (total - coalesce(sum(cap) OVER before, 0)) / (weights - coalesce(sum(weight) OVER before, 0)) AS level
        FROM limits
        WINDOW before AS (ORDER BY full_at, source NULLS LAST ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING)
    ), one AS (
        SELECT max(level) AS level FROM levels WHERE level <= full_at
    ), targets AS (
        SELECT source, source_size, CASE WHEN one.level IS NULL THEN cap ELSE least(cap, weight * one.level) END AS target
        FROM levels, one
    ), placed AS (
        SELECT d.*, t.source_size, t.target,
               CASE WHEN t.source_size > 0 THEN t.target / t.source_size ELSE 0 END AS rate,
               row_number() OVER (PARTITION BY d.source ORDER BY d.size, d.doc_id NULLS FIRST) AS place,
               CAST('0x' || substr(md5('mix/' || coalesce('=' || d.source, 'null')), 1, 8) AS BIGINT)
                   / 4294967296.0::DOUBLE AS start
        FROM sized d JOIN targets t ON d.source IS NOT DISTINCT FROM t.source
    )
    SELECT doc_id, size, source_size, target,
           CAST((floor(start + place * rate) - floor(start + (place - 1) * rate)) * size AS BIGINT) AS taken
    FROM placed
    """,
)
def op5(spark, folder):
    docs = table(spark, folder, "documents").select("doc_id", "text", "source")
    return mix_sources(docs).select("doc_id", "size", "source_size", "target", "taken")


@query("op6_toxicity")
def op6(spark, folder):
    docs = table(spark, folder, "documents").select("doc_id", "text")
    return grade(docs, train(docs, table(spark, folder, "labels")))


@query(
    "op7_minhash_near_dedup",
    r"""
    WITH RECURSIVE words AS (
        SELECT doc_id, regexp_extract_all(
            translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
            '[^\x20\x09-\x0D]+') AS w
        FROM documents
    ), starts AS (
        SELECT doc_id, w, unnest(range(1, greatest(len(w) - 4, 1) + 1)) AS i FROM words WHERE len(w) > 0
    ), shingles AS (
        SELECT DISTINCT doc_id, array_to_string(w[i : i + 4], ' ') AS s FROM starts
    ), sizes AS (
        SELECT doc_id, count(*) AS n FROM shingles GROUP BY doc_id
    ), common AS (
        SELECT x.doc_id AS a, y.doc_id AS b, count(*) AS shared
        FROM shingles x JOIN shingles y ON x.s = y.s AND x.doc_id < y.doc_id GROUP BY ALL
    ), links AS (
        SELECT a, b FROM common JOIN sizes p ON p.doc_id = a JOIN sizes q ON q.doc_id = b
        WHERE 100 * shared >= 85 * (p.n + q.n - shared)
    ), edges AS (
        SELECT a, b FROM links UNION SELECT b, a FROM links
    ), reach AS (
        SELECT doc_id, doc_id AS seen FROM documents
        UNION
        SELECT r.doc_id, e.b FROM reach r JOIN edges e ON r.seen = e.a
    ), smallest AS (
        SELECT doc_id, min(seen) AS component_id FROM reach GROUP BY doc_id
    )
    SELECT d.doc_id, coalesce(n, 0) AS n_shingles, component_id, d.doc_id = component_id AS kept
    FROM documents d JOIN smallest USING (doc_id) LEFT JOIN sizes USING (doc_id)
    """,
)
def op7(spark, folder):
    return near_duplicates(table(spark, folder, "documents").select("doc_id", "text"))


def labelled_texts(docs, labelled):
    """Rows of ``docs`` with a label. Shuffled at any size: sent to all tasks, the labels would grow with the table."""
    return docs.join(labelled.hint("merge"), "doc_id", "left_semi")


@query("op8_token_counts")
def op8(spark, folder):
    """All documents are inserted, those whose labels say low quality are deleted, the inserts are sent again, which changes nothing,
    and the deleted ones are put in again. Then a batch revises the counts of the labelled documents: they are counted with a
    vocabulary for many languages instead. So the totals hold every document once."""
    docs = table(spark, folder, "documents").select("doc_id", "source", "lang", "text")
    labels = table(spark, folder, "labels").select("doc_id", "quality").filter("doc_id IS NOT NULL")
    junk, labelled = labels.filter("quality = 0").select("doc_id").distinct(), labels.select("doc_id").distinct()

    def counted(rows, ranks):
        return materialize(with_version(count_tokens(rows, ranks, public_tokenizers.PATTERN), tokenizer_version(ranks)))

    before = counted(docs, RANKS)
    after = counted(labelled_texts(docs, labelled), MANY_LANGUAGES)
    rollup = Rollup(spark, f"{shared_dir(spark)}/rollup-{uuid.uuid4().hex}")
    rollup.commit("inserts", signed(before, 1))
    rollup.commit("junk", signed(before.join(junk, "doc_id", "left_semi"), -1))
    rollup.commit("inserts", signed(before, 1))
    rollup.commit("junk again", signed(before.join(junk, "doc_id", "left_semi"), 1))
    rollup.commit("recounted", revised(before.join(labelled, "doc_id", "left_semi"), after))
    return rollup.totals()


@query("op9_token_ids")
def op9(spark, folder):
    with open(public_tokenizers.path("byte_bpe_50k.json"), encoding="utf-8") as f:
        tokenizer = f.read()
    path = f"{shared_dir(spark)}/ids-{uuid.uuid4().hex}"
    write_ids(table(spark, folder, "documents").select("doc_id", "text"), tokenizer, path)
    return read_ids(spark, path)


@query("op10_multi_index_hashing")
def op10(spark, folder):
    vectors = table(spark, folder, "embeddings").select("vec_id", "embedding")
    return nearest(vectors, vectors.filter(F.col("vec_id") % 20 == 0), k=20)


def json_tokenizer():
    with open(public_tokenizers.path("byte_bpe_50k.json"), encoding="utf-8") as f:
        return f.read()


@query("op11_chunk_bpe")
def op11(spark, folder):
    docs = encode_chunks(table(spark, folder, "documents").select("doc_id", "text"), json_tokenizer())
    return docs.select("doc_id", "n_tokens", F.sha2("ids", 256).alias("ids_sha256"), F.sha2(F.col("decoded").cast("binary"), 256).alias("decoded_sha256"))


@query(
    "op12_collocations",
    r"""
    WITH pieces AS (
        SELECT coalesce(lang, 'und') AS lang, unnest(regexp_split_to_array(
            translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
            '[.,;:!?\x0A-\x0D]')) AS piece
        FROM documents
    ), starts AS (
        SELECT lang, w, unnest(range(1, len(w) + 1)) AS i
        FROM (SELECT lang, regexp_extract_all(piece, '[^\x20\x09]+') AS w FROM pieces)
    ), phrases AS (
        SELECT lang, m, array_to_string(w[i : i + m - 1], ' ') AS phrase, count(*) AS f
        FROM starts, (SELECT unnest([1, 2, 3]) AS m) WHERE i + m - 1 <= len(w) GROUP BY ALL
    ), totals AS (
        SELECT lang, CAST(sum(f) AS BIGINT) AS n FROM phrases WHERE m = 1 GROUP BY lang
    ), cuts AS (
        SELECT lang, m, phrase, f AS a, k, array_to_string(string_split(phrase, ' ')[1 : k], ' ') AS p,
               array_to_string(string_split(phrase, ' ')[k + 1 : m], ' ') AS q
        FROM phrases, (SELECT unnest([1, 2]) AS k) WHERE m > 1 AND k < m AND f >= 10
    ), scored AS (
        SELECT c.lang, c.m, c.phrase, a, k, x.f AS l, y.f AS r,
               CAST(1000000::HUGEINT * a * a // (x.f::HUGEINT * y.f) AS BIGINT) AS score
        FROM cuts c JOIN phrases x ON x.lang = c.lang AND x.phrase = p AND x.m = k
        JOIN phrases y ON y.lang = c.lang AND y.phrase = q AND y.m = c.m - k
    ), best AS (
        SELECT * FROM scored QUALIFY row_number() OVER (PARTITION BY lang, phrase ORDER BY score, k) = 1
    ), longer AS (
        SELECT lang, unnest([array_to_string(w[1 : 2], ' '), array_to_string(w[2 : 3], ' ')]) AS phrase, a
        FROM (SELECT lang, string_split(phrase, ' ') AS w, a FROM best WHERE m = 3)
    ), kept AS (
        SELECT * FROM best b WHERE NOT EXISTS (
            SELECT 1 FROM longer g WHERE b.m = 2 AND g.lang = b.lang AND g.phrase = b.phrase AND 100 * g.a >= 50 * b.a)
    )
    SELECT lang, row_number() OVER best_first AS rank, phrase, a, l, r, n, score FROM kept JOIN totals USING (lang)
    WINDOW best_first AS (PARTITION BY lang ORDER BY score DESC, a DESC, phrase)
    QUALIFY rank <= 2000
    """,
)
def op12(spark, folder):
    return collocations(table(spark, folder, "documents").select("text", "lang"))


@query("op13_prefix_trie")
def op13(spark, folder):
    turns = materialize(number_turns(table(spark, folder, "conversations")))
    rebuilt, every = rebuild(turns, F.expr("conv_id - conv_id % 100"), F.expr("crc32(CAST(CAST(conv_id AS string) AS binary)) % 6"))
    return prefix_trie(rebuilt, every)
