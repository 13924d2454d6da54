"""Registered queries of the operators for training text."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from meteospark.llm import (
    chat,
    decontamination,
    jaccard_join,
    mixing,
    packing,
    phrases,
    quality,
    secrets,
    sharding,
    spelling,
    substring_dedup,
    suffix_dedup,
    topk,
)
from meteospark.llm.common import stored

QUERIES: dict = {}
ORACLE: dict[str, str] = {}


def query(fn):
    QUERIES[fn.__name__] = fn
    return fn


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


@query
def op7_interleaved_shards(spark, sf_dir):
    shards = sharding.interleaved_shards(table(spark, sf_dir, "documents"), shards=8)
    return shards.select(
        "doc_id",
        "size",
        "text_crc32",
        F.lit("rows").alias("law"),
        "shard",
        "slot",
        F.lit(None).cast("int").alias("grown_shard"),
        "source",
    )


@query
def op10_temperature_mix(spark, sf_dir):
    return mixing.mixed(table(spark, sf_dir, "documents"), max_repetition=4.0)


@query
def op9_entropy_secrets(spark, sf_dir):
    scanned = secrets.scan_secrets(table(spark, sf_dir, "documents")).select("doc_id", "secret_spans")
    of = lambda k: F.filter("secret_spans", lambda s: s["kind"] == k)
    base = F.filter("secret_spans", lambda s: s["kind"] < 3)
    return scanned.select(
        "doc_id",
        *[F.size(of(k)).cast("long").alias(f"n_{secrets.KINDS[k]}") for k in range(4)],
        F.sha2(secrets.span_text(base), 256).alias("base_sha256"),
        secrets.span_text(F.col("secret_spans")).alias("spans"),
    )


@query
def op4_host_rules(spark, sf_dir):
    docs = table(spark, sf_dir, "documents").select("doc_id", "source", "text")
    m = lambda f: F.col(f"_measured.{f}").alias(f)
    fields = [m(f) for f in ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words")]
    return quality.judged(docs).select(
        "doc_id", *fields, F.col("_base_failed").alias("base_failed"), F.col("_kept").alias("kept")
    )


@query
def op2_chat_parts(spark, sf_dir):
    said = table(spark, sf_dir, "conversations").select("conv_id", "turn", "role", "text")
    own = spark.range(2).select(
        F.lit(-7).cast("long").alias("conv_id"),
        F.col("id").alias("turn"),
        F.when(F.col("id") == 0, "user").otherwise("assistant").alias("role"),
        F.lit("</s>[INST] ok [/INST]").alias("text"),
    )
    return chat.digests(chat.format_chats(chat.text_messages(said.unionByName(own))))


@query
def op3_best_fit_packing(spark, sf_dir):
    return packing.packed_documents(table(spark, sf_dir, "documents"), tokenizer_path())


def tokenizer_path() -> str:
    import public_tokenizers

    return public_tokenizers.path("word_bpe_49k.json")


@query
def op6_pivot_top5(spark, sf_dir):
    vectors = topk.integer_vectors(table(spark, sf_dir, "embeddings"))
    return topk.top_k(vectors, F.col("id") % 50 == 0, k=5)


ORACLE["op6_pivot_top5"] = """
WITH v AS (SELECT vec_id, [floor(256 * x::DOUBLE) FOR x IN embedding] AS v FROM embeddings
    WHERE vec_id IS NOT NULL AND embedding IS NOT NULL AND len([x FOR x IN embedding IF x IS NULL OR NOT isfinite(x)]) = 0),
s AS (SELECT q.vec_id AS query_id, c.vec_id, list_inner_product(q.v, c.v)::BIGINT AS score
    FROM v q JOIN v c ON q.vec_id <> c.vec_id AND len(q.v) = len(c.v) WHERE q.vec_id % 50 = 0),
r AS (SELECT *, row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id)::INTEGER AS rank FROM s)
SELECT query_id, rank, vec_id, score FROM r WHERE rank <= 5
"""


@query
def op1_window_dedup(spark, sf_dir):
    return substring_dedup.remove_repeated_windows(table(spark, sf_dir, "documents"), window=50)


ORACLE["op1_window_dedup"] = r"""
WITH w AS (SELECT doc_id, regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') AS words FROM documents),
s AS (SELECT doc_id, p, array_to_string(words[p:p + 49], ' ') AS seq
    FROM (SELECT doc_id, words, unnest(generate_series(1, len(words) - 49)) AS p FROM w WHERE len(words) >= 50)),
f AS (SELECT seq, min(doc_id) AS first_doc FROM s GROUP BY seq),
gone AS (SELECT s.doc_id, list(s.p) AS starts FROM s JOIN f USING (seq) WHERE s.doc_id > f.first_doc GROUP BY s.doc_id),
covered AS (SELECT DISTINCT doc_id, unnest(generate_series(a, a + 49)) AS pos FROM (SELECT doc_id, unnest(starts) AS a FROM gone)),
k AS (SELECT doc_id, words, coalesce(list(pos) FILTER (WHERE pos IS NOT NULL), []) AS hit
    FROM w LEFT JOIN covered USING (doc_id) GROUP BY doc_id, words),
kept AS (SELECT doc_id, len(words) AS n, len(hit) AS r,
    CASE WHEN len(hit) = 0 THEN words
         ELSE [words[i] FOR i IN list_filter(generate_series(1, len(words)), lambda i: NOT list_contains(hit, i))] END AS left_words
    FROM k)
SELECT doc_id, n AS n_words, r AS n_removed, sha256(array_to_string(left_words, ' ')) AS kept_sha256 FROM kept
"""


@query
def op8_jaccard_join(spark, sf_dir):
    return jaccard_join.jaccard_classes(table(spark, sf_dir, "documents"))


ORACLE["op8_jaccard_join"] = r"""
WITH RECURSIVE w AS (
    SELECT doc_id, regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') AS words FROM documents),
g AS (SELECT DISTINCT doc_id, array_to_string(words[p:p + 4], ' ') AS gram
    FROM (SELECT doc_id, words, unnest(generate_series(1, greatest(len(words) - 4, 1))) AS p FROM w WHERE len(words) > 0)),
n AS (SELECT doc_id, count(*) AS grams, md5(string_agg(gram, chr(10) ORDER BY gram)) AS set_id FROM g GROUP BY doc_id),
i AS (SELECT a.doc_id AS a, b.doc_id AS b, count(*) AS common FROM g a JOIN g b ON a.gram = b.gram AND a.doc_id <> b.doc_id GROUP BY 1, 2),
l AS (SELECT i.a, i.b, x.set_id AS sa, y.set_id AS sb FROM i JOIN n x ON x.doc_id = i.a JOIN n y ON y.doc_id = i.b
    WHERE 5 * common >= 4 * (x.grams + y.grams - common)),
reach(doc_id, other) AS (SELECT doc_id, doc_id FROM documents UNION SELECT reach.doc_id, l.b FROM reach JOIN l ON l.a = reach.other),
c AS (SELECT doc_id, min(other) AS class_id FROM reach GROUP BY doc_id),
k AS (SELECT a AS doc_id, count(*) AS n_links, count(DISTINCT sb) FILTER (WHERE sa <> sb) AS n_text_links FROM l GROUP BY a)
SELECT doc_id, class_id, coalesce(n_links, 0) AS n_links, coalesce(n_text_links, 0) AS n_text_links
FROM c LEFT JOIN k USING (doc_id)
"""


@query
def op5_run_index_dedup(spark, sf_dir):
    return suffix_dedup.remove_repeated_bytes(table(spark, sf_dir, "documents"), window=100)


ORACLE["op2_chat_parts"] = r"""
WITH t AS (SELECT conv_id, turn, coalesce(role, '') AS role, coalesce(text, '') AS text FROM conversations
    UNION ALL SELECT -7, 0, 'user', '</s>[INST] ok [/INST]' UNION ALL SELECT -7, 1, 'assistant', '</s>[INST] ok [/INST]'),
e AS (SELECT *, replace(replace(replace(replace(replace(replace(replace(replace(text, '\', '\\'), '<|', '<\|'), '[INST]', '[\INST]'),
    '[/INST]', '[\/INST]'), '<s>', '<\s>'), '</s>', '<\/s>'), '<<SYS>>', '<\<SYS>>'), '<</SYS>>', '<\</SYS>>') AS escaped FROM t)
SELECT conv_id, count(*) AS n_turns, sha256(string_agg(role || chr(10) || text || chr(10), '' ORDER BY turn)) AS turns_sha256,
    coalesce(sum(length(text)) FILTER (role = 'assistant'), 0)::BIGINT AS loss_chars,
    sha256(coalesce(string_agg(text, '' ORDER BY turn) FILTER (role = 'assistant'), '')) AS loss_sha256,
    sum(length('<|im_start|>') + length(role) + 1 + length(escaped) + length('<|im_end|>') + 1)::BIGINT AS formatted_chars,
    sum(len(regexp_extract_all(text, '[^\x20\x09-\x0D]+')))::BIGINT AS n_tokens, 0::BIGINT AS n_attachments
FROM e GROUP BY conv_id
"""

ORACLE["op4_host_rules"] = r"""
WITH w AS (SELECT doc_id, source, coalesce(text, '') AS text, regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') AS words,
    [x FOR x IN string_split(coalesce(text, ''), chr(10)) IF regexp_matches(x, '[^\x20\x09-\x0D]')] AS lines FROM documents),
g AS (SELECT doc_id, p, array_to_string(words[p:p + 2], ' ') AS gram FROM (
    SELECT doc_id, words, unnest(generate_series(1, len(words) - 2)) AS p FROM w WHERE len(words) > 2)),
r AS (SELECT doc_id, count(DISTINCT q) AS n_repeat_words FROM (SELECT doc_id, unnest([p, p + 1, p + 2]) AS q FROM (
    SELECT doc_id, p, count(*) OVER (PARTITION BY doc_id, gram) AS n FROM g) WHERE n > 1) GROUP BY doc_id),
m AS (SELECT w.doc_id, source, len(words) AS n_words, length(array_to_string(words, '')) AS word_chars,
    length(text) - length(regexp_replace(text, '[#*$%&|<>]', '', 'g')) AS n_symbols, len(lines) AS n_lines,
    len(lines) - len(list_distinct(lines)) AS n_dup_lines, coalesce(n_repeat_words, 0) AS n_repeat_words FROM w LEFT JOIN r USING (doc_id)),
f AS (SELECT *, n_words < 50 AS f1, 100 * n_repeat_words > 50 * n_words AS f2, 10 * n_symbols > word_chars AS f3,
    100 * n_dup_lines > 30 * n_lines AS f4, 100 * n_repeat_words > 25 * n_words AS f5 FROM m),
h AS (SELECT source, rule, count(*) AS n, count(*) FILTER (failed) AS k FROM (
    SELECT source, unnest([1, 2, 3, 4, 5]) AS rule, unnest([f1, f2, f3, f4, f5]) AS failed FROM f) GROUP BY ALL),
p AS (SELECT rule, sum(k) / sum(n) AS p, sum(n) AS total FROM h GROUP BY rule),
s AS (SELECT rule, p, total, count(*) AS hosts, sum(n * (k / n - p) * (k / n - p)) AS ss, sum(n::DOUBLE * n) AS nn
    FROM h JOIN p USING (rule) GROUP BY ALL),
b AS (SELECT rule, p, total, CASE WHEN total - nn / total > 0 THEN (ss - (hosts - 1) * p * (1 - p)) / (total - nn / total) ELSE 0 END AS between_hosts FROM s),
c AS (SELECT rule, p, greatest(CASE WHEN between_hosts > 0 THEN p * (1 - p) / between_hosts - 1 ELSE total * 1e6 END, 1) AS strength FROM b),
v AS (SELECT source, bool_or((k + p * strength) / (n + strength) > 0.5) AS bad FROM h JOIN c USING (rule) GROUP BY source)
SELECT doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, f1 OR f2 AS base_failed,
    NOT (f1 OR f2) AND NOT (bad AND (f3 OR f4 OR f5)) AS kept
FROM f JOIN v ON f.source IS NOT DISTINCT FROM v.source
"""


def _matches_sql(kind: int, pattern: str, where: str, source: str) -> str:
    """Spans of a pattern: the lengths of the matches and of the texts between them, added up."""
    return f"""SELECT doc_id, {kind} AS kind, list_sum(gaps[:i]) + coalesce(list_sum(sizes[:i - 1]), 0) AS a,
    list_sum(gaps[:i]) + list_sum(sizes[:i]) AS z, found[i] AS word, grp[i] AS part FROM (
    SELECT doc_id, found, grp, [length(m) FOR m IN found] AS sizes, [length(m) FOR m IN gaps] AS gaps, unnest(generate_series(1, len(found))) AS i
    FROM (SELECT doc_id, regexp_extract_all(text, {pattern}, 0) AS found, regexp_extract_all(text, {pattern}, {2 if kind == 0 else 0}) AS grp,
        string_split_regex(text, {pattern}) AS gaps FROM {source}) WHERE len(found) > 0) WHERE {where.replace('WORD', 'found[i]').replace('PART', 'grp[i]')}"""


_ASSIGN_SQL = "'" + secrets.ASSIGN.replace("'", "''") + "'"
ORACLE["op9_entropy_secrets"] = f"""
WITH t AS (SELECT doc_id, coalesce(text, '') AS text FROM documents),
base AS ({_matches_sql(0, _ASSIGN_SQL, "length(PART) >= 6", "t")}
    UNION ALL {_matches_sql(1, "'AKIA[A-Z0-9]+'", "length(WORD) >= 20", "t")}
    UNION ALL {_matches_sql(2, "'[0-9a-f]+'", "length(WORD) >= 24", "(SELECT * FROM t WHERE regexp_matches(text, '[0-9a-f]{24}'))")}),
cand AS (SELECT * FROM ({_matches_sql(3, "'" + secrets.CANDIDATE + "'", "true", "t")})
    WHERE NOT ({" OR ".join(f"regexp_matches(word, '{p}')" for p in secrets.ALLOWED)})),
high AS (SELECT doc_id, a, a + i - 1 AS lo, lag(a + i - 1) OVER (PARTITION BY doc_id, a ORDER BY i) AS before
    FROM (SELECT *, substr(word, i, {secrets.WINDOW}) AS win FROM (SELECT *, unnest(generate_series(1, length(word) - {secrets.WINDOW - 1})) AS i FROM cand))
    WHERE list_entropy(string_split(win, '')) >= CASE {" ".join(f"WHEN trim(win, '{letters}') = '' THEN {bits}" for _, letters, bits in secrets.CLASSES)} END - 1e-12),
runs AS (SELECT *, count(*) FILTER (before IS NULL OR lo - before > {secrets.WINDOW}) OVER (PARTITION BY doc_id, a ORDER BY lo) AS run FROM high),
spans AS (SELECT doc_id, kind, a, z FROM base UNION ALL
    SELECT doc_id, 3, min(lo), max(lo) + {secrets.WINDOW} FROM runs GROUP BY doc_id, a, run),
named AS (SELECT *, ['assign', 'access', 'hex', 'entropy'][kind + 1] || ':' || a::BIGINT || ':' || z::BIGINT AS s FROM spans)
SELECT t.doc_id, count(*) FILTER (kind = 0) AS n_assign, count(*) FILTER (kind = 1) AS n_access, count(*) FILTER (kind = 2) AS n_hex,
    count(*) FILTER (kind = 3) AS n_entropy,
    sha256(coalesce(string_agg(s, ',' ORDER BY a, kind, z) FILTER (kind < 3), '')) AS base_sha256,
    coalesce(string_agg(s, ',' ORDER BY a, kind, z), '') AS spans
FROM t LEFT JOIN named USING (doc_id) GROUP BY t.doc_id
"""


@query
def op12_fm_decontamination(spark, sf_dir):
    indexes = stored(decontamination.shard_indexes(table(spark, sf_dir, "documents")), "indexes")
    found = decontamination.find_phrases(indexes, table(spark, sf_dir, "benchmark"), size=10)
    n_hit = decontamination.covered(F.col("spans"))
    return found.select(
        "doc_id",
        "n_words",
        n_hit.alias("n_hit"),
        F.size("items").cast("long").alias("n_items"),
        F.sha2(F.array_join("items", ","), 256).alias("items_sha256"),
        (n_hit > 0).alias("contaminated"),
    )


_LOWER = "translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"
ORACLE["op12_fm_decontamination"] = rf"""
WITH d AS (SELECT doc_id, regexp_extract_all({_LOWER}, '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS words FROM documents),
b AS (SELECT item_id, regexp_extract_all({_LOWER}, '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS words FROM benchmark),
w AS (SELECT DISTINCT item_id, least(10, len(words)) AS size, array_to_string(words[p:p + 9], ' ') AS seq
    FROM (SELECT *, unnest(generate_series(1, greatest(1, len(words) - 9))) AS p FROM b WHERE len(words) > 0)),
sizes AS (SELECT DISTINCT size FROM w),
s AS (SELECT doc_id, size, p, array_to_string(words[p:p + size - 1], ' ') AS seq
    FROM (SELECT doc_id, words, size, unnest(generate_series(1, len(words) - size + 1)) AS p FROM d, sizes WHERE len(words) >= size)),
f AS (SELECT s.doc_id, s.p, w.size, w.item_id FROM s JOIN w USING (size, seq)),
hit AS (SELECT doc_id, count(DISTINCT pos) AS n_hit
    FROM (SELECT doc_id, unnest(generate_series(p, p + size - 1)) AS pos FROM f) GROUP BY doc_id),
named AS (SELECT doc_id, count(*) AS n_items, string_agg(item, ',' ORDER BY item) AS items
    FROM (SELECT DISTINCT doc_id, item_id::VARCHAR AS item FROM f WHERE item_id IS NOT NULL) GROUP BY doc_id)
SELECT d.doc_id, len(words)::BIGINT AS n_words, coalesce(n_hit, 0)::BIGINT AS n_hit, coalesce(n_items, 0)::BIGINT AS n_items,
    sha256(coalesce(items, '')) AS items_sha256, coalesce(n_hit, 0) > 0 AS contaminated
FROM d LEFT JOIN hit USING (doc_id) LEFT JOIN named USING (doc_id)
"""


@query
def op13_spelling_groups(spark, sf_dir):
    words = spelling.counted_words(table(spark, sf_dir, "documents"), drop_every=31)
    return spelling.spelling_groups(words).select("word", "form", "root", "n", "n_near", "form_n")


ORACLE["op13_spelling_groups"] = rf"""
WITH RECURSIVE crc AS (SELECT list(c ORDER BY i) AS t FROM (SELECT i, list_reduce(list_prepend(i, range(8)),
        lambda c, k: CASE WHEN c & 1 = 1 THEN xor(3988292384, c >> 1) ELSE c >> 1 END) AS c FROM range(256) r(i))),
runs AS (SELECT doc_id, w, count(*) AS k
    FROM (SELECT doc_id, unnest(regexp_extract_all({_LOWER}, '[A-Za-zÀ-ÿ]+')) AS w FROM documents) WHERE length(w) >= 7 GROUP BY ALL),
bytes AS (SELECT *, hex(encode(doc_id || ':' || w)) AS x FROM runs),
hashed AS (SELECT w, k, xor(4294967295, list_reduce(
        list_prepend(4294967295, [('0x' || substr(x, (2 * i - 1)::INT, 2))::BIGINT FOR i IN range(1, length(x) // 2 + 1)]),
        lambda c, b: xor(t[xor(c & 255, b) + 1], c >> 8))) AS h FROM bytes, crc),
made AS (SELECT CASE WHEN h % 31 = 0 THEN substr(w, 1, h % length(w)) || substr(w, h % length(w) + 2) ELSE w END AS word, k FROM hashed),
words AS (SELECT word, sum(k)::BIGINT AS n FROM made GROUP BY word HAVING sum(k) >= 2 AND length(word) >= 7),
cut AS (SELECT word, n, i, substr(word, 1, i - 1) || substr(word, i + 1) AS rest
    FROM (SELECT *, unnest(range(1, length(word) + 1)) AS i FROM words)),
pairs AS (SELECT a.word, b.word AS other, b.n AS other_n FROM cut a JOIN cut b USING (rest, i) WHERE a.word <> b.word
    UNION SELECT a.word, b.word, b.n FROM cut a JOIN words b ON a.rest = b.word
    UNION SELECT b.word, a.word, a.n FROM cut a JOIN words b ON a.rest = b.word),
best AS (SELECT word, count(*) AS n_near, first(other ORDER BY other_n DESC, other) AS other, max(other_n) AS other_n FROM pairs GROUP BY word),
f AS (SELECT word, n, coalesce(n_near, 0) AS n_near, CASE WHEN other_n >= 10 * n THEN other END AS form,
    CASE WHEN other_n >= 10 * n THEN other_n END AS form_n FROM words LEFT JOIN best USING (word)),
walk AS (SELECT word, word AS root, form AS up FROM f UNION ALL SELECT walk.word, f.word, f.form FROM walk JOIN f ON walk.up = f.word)
SELECT word, form, root, n, n_near::BIGINT AS n_near, form_n::BIGINT AS form_n FROM f JOIN (SELECT word, root FROM walk WHERE up IS NULL) USING (word)
"""


@query
def op11_era_phrases(spark, sf_dir):
    found = phrases.collocations(table(spark, sf_dir, "documents"), max_words=3, min_count=10, top=2000)
    return found.withColumn("rank", F.col("rank").cast("long"))


ORACLE["op11_era_phrases"] = rf"""
WITH t AS (SELECT coalesce(lang, 'und') AS lang, unnest(string_split_regex({_LOWER}, '[.,;:!?\x0A-\x0D]')) AS piece FROM documents),
w AS (SELECT lang, regexp_extract_all(piece, '[^\x20\x09]+') AS words FROM t),
g AS (SELECT lang, size, array_to_string(words[p:p + size - 1], ' ') AS phrase
    FROM (SELECT lang, words, size, unnest(generate_series(1, len(words) - size + 1)) AS p FROM w, range(1, 4) r(size) WHERE len(words) >= size)),
f AS (SELECT lang, size, phrase, count(*) AS n FROM g GROUP BY ALL),
totals AS (SELECT lang, sum(n)::BIGINT AS n FROM f WHERE size = 1 GROUP BY lang),
c AS (SELECT lang, size, phrase, n AS a, string_split(phrase, ' ') AS words FROM f WHERE size > 1 AND n >= 10),
cuts AS (SELECT *, array_to_string(words[:k], ' ') AS lhs, array_to_string(words[k + 1:], ' ') AS rhs
    FROM (SELECT *, unnest(generate_series(1, size - 1)) AS k FROM c)),
s AS (SELECT cuts.*, l.n AS l, r.n AS r, (1000000::HUGEINT * a * a // (l.n::HUGEINT * r.n))::BIGINT AS score
    FROM cuts JOIN f l ON cuts.lang = l.lang AND cuts.lhs = l.phrase JOIN f r ON cuts.lang = r.lang AND cuts.rhs = r.phrase),
best AS (SELECT * FROM s QUALIFY row_number() OVER (PARTITION BY lang, phrase ORDER BY score, k) = 1),
inner_ AS (SELECT lang, array_to_string(words[i:i + 1], ' ') AS phrase, max(a) AS longer
    FROM (SELECT *, unnest([1, 2]) AS i FROM c WHERE size = 3) GROUP BY ALL),
kept AS (SELECT best.* FROM best LEFT JOIN inner_ USING (lang, phrase) WHERE longer IS NULL OR 100 * longer < 50 * a),
ranked AS (SELECT *, row_number() OVER (PARTITION BY lang ORDER BY score DESC, a DESC, phrase) AS rank FROM kept)
SELECT lang, rank, phrase, a, l, r, n, score FROM ranked JOIN totals USING (lang) WHERE rank <= 2000
"""
