"""One query per operator, bound to the driver tables with production parameters."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from terrasol.llm import (chat_format, collocations, fingerprints, html_extract, lm_score, mixing, near_dedup, packing,
                          periodic_runs, quality, secrets, sharding, topk_search)
from terrasol.llm.common import id_crc
from terrasol.sources.tables import table


def tokenizer_file(name: str) -> str:
    """Place of a public vocabulary file on this machine (the same on every executor)."""
    import public_tokenizers
    return public_tokenizers.path(name)


def op1_lm_score(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Log10 probabilities of all documents under the trigram automaton of the training rows."""
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    held_out = id_crc() % 7 == 2
    scored = lm_score.score_texts(docs, ~held_out, lm_score.ORDER, lm_score.FALLING)
    return scored.select("doc_id", (~F.col("train")).alias("held_out"), "n_tokens", "n_known", "train_tokens", "base_score",
                         "score")


def op2_topk(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The 20 best candidates of every vector whose id is divisible by 20."""
    vectors = topk_search.integer_vectors(table(spark, sf_dir, "embeddings"))
    return topk_search.top_k(vectors, F.col("vec_id") % 20 == 0, 20)


def op3_mix(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Documents mixed to 150% of all words, sources weighing 3, 1, 2, at most twice each document."""
    mixed = mixing.mix(table(spark, sf_dir, "documents"))
    return mixed.select("doc_id", "size", "source_size", "target", "taken")


def op4_chat_format(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All conversations and conversation -7, formatted and read back from the formatted text."""
    rows = table(spark, sf_dir, "conversations").select("conv_id", "turn", "role", "text")
    control = F.lit("</s>[INST] ok [/INST]")
    more = spark.range(2).select(F.lit(-7).cast("long").alias("conv_id"), F.col("id").alias("turn"),
                                 F.when(F.col("id") == 0, "user").otherwise("assistant").alias("role"), control.alias("text"))
    part = F.array(F.struct(F.lit("text").alias("type"), F.col("text"), *(F.lit(None).alias(c) for c in ("ref", "width", "height", "seconds", "pages"))))
    done = chat_format.format_conversations(rows.unionByName(more).withColumn("parts", part.cast(chat_format.PARTS)))
    back = chat_format.read_back(done)
    under = F.array_join(F.transform(chat_format.masked("turns", "loss_spans"), lambda x: x["text"]), "")
    back = back.withColumn("_loss", under)
    return back.select(
        "conv_id", F.size("turns").cast("long").alias("n_turns"),
        F.sha2(F.array_join(F.transform("turns", lambda x: F.concat(x["role"], F.lit("\n"), x["text"], F.lit("\n"))), "").cast("binary"), 256).alias("turns_sha256"),
        F.length("_loss").cast("long").alias("loss_chars"), F.sha2(F.col("_loss").cast("binary"), 256).alias("loss_sha256"),
        F.length("formatted").cast("long").alias("formatted_chars"))


def op5_secrets(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Secrets of all documents: the known patterns and what looks random."""
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    found = secrets.scan(docs, secrets.train(docs))
    count = lambda k: F.size(F.filter("base", lambda s: s["kind"] == k)).cast("long").alias(f"n_{k}")
    return found.select("doc_id", *(count(k) for k in secrets.KINDS), F.sha2(secrets.listed("base").cast("binary"), 256).alias("base_sha256"),
                        secrets.listed("spans").alias("spans"))


def op6_html_extract(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Main text of all pages."""
    pages = table(spark, sf_dir, "pages")
    return html_extract.extract(pages, html_extract.learn(pages))


def op7_fingerprints(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Fingerprints of all documents and of their edited texts, and how alike they are."""
    return fingerprints.fingerprint_edits(table(spark, sf_dir, "documents").select("doc_id", "text"))


def op8_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Quality scores of all documents, learned from the labelled rows outside the held-out third."""
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    weights = quality.train(docs, table(spark, sf_dir, "labels"))
    scored = quality.score(docs, weights)
    return scored.select("doc_id", (id_crc() % 3 == 1).alias("held_out"), "score", (F.col("score") >= 0.5).cast("int").alias("predicted"))


def op9_pack(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Documents packed into sequences of at most 1024 tokens."""
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    return packing.pack_documents(docs, tokenizer_file("byte_bpe_50k.json"), ranks=tokenizer_file("byte_bpe_50k.tiktoken"))


def op10_near_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Near-duplicate groups of all documents (five-word shingles, similarity 0.75)."""
    return near_dedup.near_duplicates(table(spark, sf_dir, "documents"))


def op11_periodic_runs(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Runs of repeated words in all documents, every tenth of which is made periodic first."""
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    return periodic_runs.periodic_runs(docs, periodic_runs.repeated).drop("n_words", "runs")


def op12_collocations(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The 2000 best phrases of two and three words of each language in all documents."""
    return collocations.collocations(table(spark, sf_dir, "documents"))


def op13_sharding(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All documents in 8 shards of a tree of 2 regions, and in 9 when a rack gets one more."""
    tree = sharding.even_tree(8)
    return sharding.shard_documents(table(spark, sf_dir, "documents"), tree, sharding.grown(tree, "region0", "rack0"))


QUERIES = {f.__name__: f for f in (op1_lm_score, op2_topk, op3_mix, op4_chat_format, op5_secrets, op6_html_extract, op7_fingerprints, op8_quality, op9_pack,
                                   op10_near_dedup, op11_periodic_runs, op12_collocations, op13_sharding)}
ORACLES = {
    "op2_topk": """
        WITH v AS (
            SELECT row_number() OVER () AS n, vec_id, list_transform(embedding, lambda x: CAST(floor(64 * CAST(x AS DOUBLE)) AS BIGINT)) AS v
            FROM embeddings
            WHERE vec_id IS NOT NULL AND embedding IS NOT NULL
              AND len(list_filter(embedding, lambda x: x IS NULL OR isnan(x) OR isinf(x))) = 0),
        s AS (
            SELECT q.n, q.vec_id AS query_id, c.vec_id AS vec_id,
                   CAST(coalesce(list_sum(list_transform(range(1, least(len(q.v), len(c.v)) + 1), lambda i: q.v[i] * c.v[i])), 0) AS BIGINT) AS score
            FROM v q JOIN v c ON q.vec_id % 20 = 0 AND q.n <> c.n),
        r AS (SELECT *, row_number() OVER (PARTITION BY n ORDER BY score DESC, vec_id) AS k FROM s)
        SELECT query_id, CAST(k AS INTEGER) AS rank, vec_id, score FROM r WHERE k <= 20""",
    "op4_chat_format": r"""
        WITH t AS (
            SELECT conv_id, turn, coalesce(role, '') AS role, coalesce(text, '') AS body FROM conversations
            UNION ALL SELECT -7, 0, 'user', '</s>[INST] ok [/INST]'
            UNION ALL SELECT -7, 1, 'assistant', '</s>[INST] ok [/INST]'),
        e AS (
            SELECT *, len(regexp_extract_all(role || ' ' || body,
                '[<\[]\\*(\|turn\|>|\|text\|>|\|end\|>|\|image\|>|\|audio\|>|\|document\|>|\|endoftext\|>|s>|/s>|INST\]|/INST\]|<SYS>>|</SYS>>)')) AS extra
            FROM t)
        SELECT conv_id, count(*) AS n_turns,
               sha256(string_agg(role || chr(10) || body || chr(10), '' ORDER BY turn, role, body)) AS turns_sha256,
               length(coalesce(string_agg(CASE WHEN role = 'assistant' THEN body END, '' ORDER BY turn, role, body), '')) AS loss_chars,
               sha256(coalesce(string_agg(CASE WHEN role = 'assistant' THEN body END, '' ORDER BY turn, role, body), '')) AS loss_sha256,
               CAST(sum(8 + length(role) + 8 + length(body) + 7 + extra) AS BIGINT) AS formatted_chars
        FROM e GROUP BY conv_id""",
    # the driver's pages mark the article with an element; the query itself does not rely on it
    "op6_html_extract": r"""
        WITH a AS (SELECT page_id, url, regexp_replace(regexp_extract(html, '(?s)<article>(.*?)</article>', 1), '</?(b|i|em|a|span|strong)( [^>]*)?>', '', 'g') AS h FROM pages),
        t AS (SELECT page_id, url, trim(regexp_replace(regexp_replace(replace(regexp_replace(h, '<[^>]*>', ' ', 'g'), '&quot;', '"'), '&amp;?', '&', 'g'), '\s+', ' ', 'g')) AS text FROM a)
        SELECT page_id, url, text, length(text) AS n_chars FROM t""",
    "op12_collocations": r"""
        WITH p AS (
            SELECT coalesce(lang, 'und') AS lang,
                   unnest(string_split_regex(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[.,;:!?\x0A-\x0D]')) AS piece
            FROM documents),
        w AS (SELECT lang, list_filter(string_split_regex(piece, '[\x20\x09]+'), lambda x: x <> '') AS ws FROM p),
        g AS (SELECT lang, m, unnest(list_transform(range(1, len(ws) - m + 2), lambda i: ws[i:i + m - 1])) AS ws FROM w, range(1, 4) t(m)),
        f AS (SELECT lang, ws, array_to_string(ws, ' ') AS phrase, count(*) AS f FROM g GROUP BY lang, ws),
        n AS (SELECT lang, CAST(sum(f) AS BIGINT) AS n FROM f WHERE len(ws) = 1 GROUP BY lang),
        c AS (SELECT lang, ws, phrase, f AS a FROM f WHERE len(ws) > 1 AND f >= 10),
        k AS (SELECT c.*, unnest(range(1, len(ws))) AS k FROM c),
        s AS (
            SELECT k.lang, k.phrase, k.a, k.k, x.f AS l, y.f AS r,
                   CAST((1000000::HUGEINT * k.a * k.a) // (x.f::HUGEINT * y.f) AS BIGINT) AS score
            FROM k JOIN f x ON x.lang = k.lang AND x.ws = k.ws[1:k.k] JOIN f y ON y.lang = k.lang AND y.ws = k.ws[k.k + 1:]),
        b AS (SELECT * FROM s QUALIFY row_number() OVER (PARTITION BY lang, phrase ORDER BY score, k) = 1),
        i AS (
            SELECT lang, phrase, max(a) AS around
            FROM (SELECT lang, a, array_to_string(unnest([ws[1:2], ws[2:3]]), ' ') AS phrase FROM c WHERE len(ws) = 3) GROUP BY lang, phrase),
        d AS (SELECT b.* FROM b LEFT JOIN i USING (lang, phrase) WHERE around IS NULL OR 100 * around < 50 * a),
        r AS (SELECT *, row_number() OVER (PARTITION BY lang ORDER BY score DESC, a DESC, phrase) AS rank FROM d)
        SELECT lang, rank, phrase, a, l, r, n, score FROM r JOIN n USING (lang) WHERE rank <= 2000""",
    "op10_near_dedup": r"""
        WITH RECURSIVE w AS (
            SELECT doc_id, list_filter(string_split_regex(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                                                          '[\x20\x09-\x0D]+'), lambda x: x <> '') AS ws
            FROM documents),
        s AS (
            SELECT doc_id, CASE WHEN len(ws) = 0 THEN [] WHEN len(ws) < 5 THEN [array_to_string(ws, ' ')]
                   ELSE list_distinct(list_transform(range(1, len(ws) - 3), lambda i: array_to_string(ws[i:i + 4], ' '))) END AS sh
            FROM w),
        u AS (SELECT doc_id, len(sh) AS n, unnest(sh) AS h FROM s),
        p AS (SELECT a.doc_id AS x, b.doc_id AS y, any_value(a.n) + any_value(b.n) AS n, count(*) AS c
              FROM u a JOIN u b ON a.h = b.h AND a.doc_id <> b.doc_id GROUP BY 1, 2),
        l AS (SELECT x, y FROM p WHERE 100 * c >= 75 * (n - c)),
        r AS (SELECT doc_id AS x, doc_id AS y FROM s UNION SELECT r.x, l.y FROM r JOIN l ON r.y = l.x)
        SELECT doc_id, CAST(len(sh) AS BIGINT) AS n_shingles, m AS component_id, doc_id = m AS kept
        FROM s JOIN (SELECT x, min(y) AS m FROM r GROUP BY x) g ON g.x = s.doc_id""",
}
