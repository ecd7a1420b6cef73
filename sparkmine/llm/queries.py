"""The registered queries of the operators and, where SQL can say the same, their SQL."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from sparkmine.llm import archives, chat, decontam, hosts, licenses, mixing, parity, pii, pseudo, repeats, transducer, variants, whitening
from sparkmine.plans.registry import registrar
from sparkmine.sources.tables import table

QUERIES: dict = {}
ORACLE: dict[str, str] = {}
query = registrar(QUERIES, ORACLE)

_WORDS = r"regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+')"
_GAP = r"[\x00-\x2F\x3A-\x60\x7B-\x7F]+"


def _tokenizer(name: str) -> str:
    import public_tokenizers

    return public_tokenizers.path(name)


@query(
    f"""
WITH RECURSIVE w AS (
  SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), '{licenses.UPPER}', '{licenses.LOWER}'), '[^\\x20\\x09-\\x0D]+') AS a FROM documents
), s AS (
  SELECT doc_id, CASE WHEN len(a) = 0 THEN [] WHEN len(a) < 4 THEN [list_aggregate(a, 'string_agg', ' ')]
    ELSE list_distinct([a[i] || ' ' || a[i + 1] || ' ' || a[i + 2] || ' ' || a[i + 3] FOR i IN range(1, len(a) - 2)]) END AS set
  FROM w
), n AS (SELECT doc_id, len(set) AS n FROM s),
t AS (SELECT doc_id, unnest(set) AS shingle FROM s),
hits AS (SELECT x.doc_id AS a, y.doc_id AS b, count(*) AS common FROM t x JOIN t y USING (shingle) WHERE x.doc_id < y.doc_id GROUP BY 1, 2),
links AS (SELECT a, b FROM hits JOIN n na ON na.doc_id = a JOIN n nb ON nb.doc_id = b WHERE 100 * common >= 85 * (na.n + nb.n - common)),
edges AS (SELECT a, b FROM links UNION SELECT b, a FROM links),
reach(a, b) AS (SELECT a, b FROM edges UNION SELECT reach.a, edges.b FROM reach JOIN edges ON reach.b = edges.a)
SELECT n.doc_id, CAST(n.n AS BIGINT) AS n_shingles, least(n.doc_id, coalesce(min(reach.b), n.doc_id)) AS component_id
FROM n LEFT JOIN reach ON reach.a = n.doc_id GROUP BY n.doc_id, n.n
"""
)
def op1_jaccard_components(spark: SparkSession, sf_dir: str) -> DataFrame:
    return parity.jaccard_components(table(spark, sf_dir, "documents"), parity.Rule(k=4, num=85, den=100))


@query(
    f"""
WITH w AS (SELECT doc_id, {_WORDS} AS a FROM documents),
win AS (
  SELECT doc_id, i, md5(list_aggregate(a[i:i + 49], 'string_agg', ' ')) AS h
  FROM (SELECT doc_id, a, unnest(range(1, len(a) - 48)) AS i FROM w)
), low AS (SELECT h, min(doc_id) AS low FROM win GROUP BY h),
hit AS (SELECT doc_id, list(i) AS starts FROM win JOIN low USING (h) WHERE low < doc_id GROUP BY doc_id),
gone AS (SELECT doc_id, list(DISTINCT p) AS places FROM (SELECT doc_id, unnest(range(s, s + 50)) AS p FROM (SELECT doc_id, unnest(starts) AS s FROM hit)) GROUP BY doc_id)
SELECT doc_id, CAST(len(a) AS BIGINT) AS n_words, CAST(coalesce(len(places), 0) AS BIGINT) AS n_removed,
  sha256(coalesce(list_aggregate([a[i] FOR i IN range(1, len(a) + 1) IF places IS NULL OR NOT list_contains(places, i)], 'string_agg', ' '), '')) AS kept_sha256
FROM w LEFT JOIN gone USING (doc_id)
"""
)
def op2_repeated_passages(spark: SparkSession, sf_dir: str) -> DataFrame:
    return repeats.digest(repeats.without_repeats(table(spark, sf_dir, "documents")))


@query()
def op3_contaminated(spark: SparkSession, sf_dir: str) -> DataFrame:
    return decontam.contaminated(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


@query()
def op4_personal_data(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    found = pii.personal_data(docs, pii.train_tagger(docs))
    return found.select("doc_id", *[f"n_{k}" for k in pii.KINDS], F.sha2("base", 256).alias("base_sha256"), "spans")


@query(
    f"""
WITH d AS (
  SELECT doc_id, source, CAST(len({_WORDS}) AS BIGINT) AS size,
    md5('0|' || coalesce(CAST(doc_id AS VARCHAR), '') || '|' || coalesce(source, '') || '|' || coalesce(text, '')) AS key
  FROM documents
), s AS (SELECT source, CAST(sum(size) AS BIGINT) AS source_size FROM d GROUP BY source),
p AS (SELECT *, row_number() OVER (ORDER BY source NULLS LAST) - 1 AS place FROM s),
w AS (SELECT *, CAST(CASE place % 3 WHEN 0 THEN 5 WHEN 1 THEN 2 ELSE 1 END AS DOUBLE) AS weight, CASE WHEN place % 2 = 0 THEN 0.5::DOUBLE ELSE -0.5::DOUBLE END AS tilt FROM p),
r AS (SELECT *, 3 * source_size / weight AS ratio FROM w),
l AS (
  SELECT *, (sum(source_size) OVER () - coalesce(sum(3 * source_size) OVER before, 0)) / (sum(weight) OVER () - coalesce(sum(weight) OVER before, 0)) AS own
  FROM r WINDOW before AS (ORDER BY ratio, source NULLS LAST ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING)
), v AS (SELECT *, max(CASE WHEN ratio >= own THEN own END) OVER () AS level FROM l),
t AS (SELECT source, source_size, tilt, CASE WHEN ratio < level THEN CAST(3 * source_size AS DOUBLE) ELSE level * weight END AS target FROM v),
q AS (
  SELECT doc_id, size, source_size, target, tilt, CAST(floor(target) AS BIGINT) AS quota,
    CAST(sum(size) OVER (PARTITION BY d.source ORDER BY key ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) - size AS BIGINT) AS before
  FROM d JOIN t ON d.source IS NOT DISTINCT FROM t.source
), u AS (
  SELECT *, list_filter([before, before + source_size, before + 2 * source_size], lambda s: s < quota AND size > 0) AS starts FROM q
), r2 AS (
  SELECT *, list_transform(starts, lambda s: round(least(greatest((1 + tilt - sqrt(greatest((1 + tilt) * (1 + tilt) - 4 * tilt * (s / target), 0.0))) / (2 * tilt), 0.0), 1.0), 9)) AS times FROM u
)
SELECT doc_id, size, source_size, target, CAST(greatest(least(before + size, quota) - before, 0)
  + greatest(least(before + source_size + size, quota) - before - source_size, 0)
  + greatest(least(before + 2 * source_size + size, quota) - before - 2 * source_size, 0) AS BIGINT) AS taken,
  CAST(len(times) AS INTEGER) AS copies, times[1] AS position, times[2] AS second_position, times[3] AS third_position
FROM r2
"""
)
def op5_mixed_sources(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = mixing.mix(table(spark, sf_dir, "documents"))
    names = ["position", "second_position", "third_position"]
    times = [F.round(F.get("positions", F.lit(i)), 9).alias(name) for i, name in enumerate(names)]
    return rows.select("doc_id", "size", "source_size", "target", "taken", F.size("positions").alias("copies"), *times)


@query(
    """
WITH p AS (SELECT page_id, coalesce(html, '') AS html, sha1(coalesce(html, '')) AS h FROM pages),
d AS (
  SELECT page_id, CAST(octet_length(encode(html)) AS BIGINT) AS payload_bytes, h,
    list_aggregate(list_transform(range(32), lambda i: substr('ABCDEFGHIJKLMNOPQRSTUVWXYZ234567',
      1 + CAST((CAST('0x' || substr(h, CAST(1 + 5 * (i // 4) AS BIGINT), 5) AS BIGINT) >> CAST(15 - 5 * (i % 4) AS BIGINT)) & 31 AS BIGINT), 1)), 'string_agg', '') AS payload_digest
  FROM p
), k AS (SELECT h, max(page_id) AS response FROM d GROUP BY h)
SELECT page_id, payload_bytes, payload_digest, CASE WHEN page_id = response THEN 'response' ELSE 'revisit' END AS record_type,
  CASE WHEN page_id <> response THEN response END AS refers_to
FROM d JOIN k USING (h)
"""
)
def op6_legacy_archives(spark: SparkSession, sf_dir: str) -> DataFrame:
    return archives.through_archives(table(spark, sf_dir, "pages")).select("page_id", "payload_bytes", "payload_digest", "record_type", "refers_to")


@query()
def op7_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return transducer.token_counts(table(spark, sf_dir, "documents"), _tokenizer("word_bpe_49k.json"))


@query()
def op8_pseudo_likelihood(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pseudo.pseudo_likelihood(table(spark, sf_dir, "documents"))


def _license_sql() -> str:
    templates = ", ".join(f"({i}, '{label}', '{text}')" for i, (label, text) in enumerate(licenses.TEMPLATES))
    phrases = ", ".join(f"('{p}', '{label}')" for p, label in licenses.PHRASES.items())
    split = f"list_filter(regexp_split_to_array(translate(coalesce({{}}, ''), '{licenses.UPPER}', '{licenses.LOWER}'), '{_GAP}'), lambda x: x <> '')"
    return f"""
WITH d AS (SELECT doc_id, text, {split.format("text")} AS a FROM documents),
phrase AS (SELECT string_split(phrase, ' ') AS q, label FROM (VALUES {phrases}) v(phrase, label)),
hit AS (
  SELECT doc_id, i, label FROM (SELECT doc_id, a, unnest(range(1, len(a) + 1)) AS i FROM d) x JOIN phrase ON x.a[i:i + len(q) - 1] = q
), base AS (
  SELECT doc_id, count(*) AS n_base, min(i) - 1 AS first_word, max(i) - 1 AS last_word, list(DISTINCT label) AS labels FROM hit GROUP BY doc_id
), template AS (SELECT id, label, list_distinct(string_split(text, ' ')) AS q, 2 * len(string_split(text, ' ')) AS width FROM (VALUES {templates}) v(id, label, text)),
texts AS (SELECT row_number() OVER () AS t, a, text FROM (SELECT DISTINCT a, coalesce(text, '') AS text FROM d)),
known AS (SELECT t, i, a[i] AS word FROM (SELECT t, a, unnest(range(1, len(a) + 1)) AS i FROM texts) WHERE a[i] IN (SELECT unnest(q) FROM template)),
held AS (SELECT t, i, word, id, label, len(q) AS size, width FROM known JOIN template ON list_contains(q, word)),
firsts AS (SELECT x.t, x.id, x.i, any_value(x.label) AS label, any_value(x.word) AS opening, any_value(x.size) AS size, y.word, min(y.i) AS place, list(y.i) AS places
  FROM held x JOIN held y ON x.t = y.t AND x.id = y.id AND y.i >= x.i AND y.i < x.i + x.width GROUP BY x.t, x.id, x.i, y.word),
blocks AS (SELECT t, id, i AS lo, any_value(label) AS label, count(*) / any_value(size) AS score, count(*) AS n, any_value(size) AS size, max(place) AS hi,
    max(list_sort(places)[2]) FILTER (word = opening) AS again FROM firsts GROUP BY t, id, i),
met AS (SELECT * FROM blocks WHERE n >= ceil({licenses.THRESHOLD} * size - 1e-9) AND (again IS NULL OR again > hi)),
good AS (SELECT * FROM met m WHERE NOT EXISTS (SELECT 1 FROM met b WHERE b.t = m.t AND b.score > m.score AND b.lo <= m.hi AND b.hi >= m.lo)),
added AS (SELECT doc_id, labels, best FROM (SELECT t, list(DISTINCT label) AS labels, max(score) AS best FROM good GROUP BY t) JOIN texts USING (t)
  JOIN (SELECT DISTINCT doc_id, a, coalesce(text, '') AS text FROM d) USING (text))
SELECT d.doc_id, CAST(len(a) AS BIGINT) AS n_words, CAST(coalesce(n_base, 0) AS BIGINT) AS n_base, CAST(first_word AS BIGINT) AS first_word, CAST(last_word AS BIGINT) AS last_word,
  coalesce(list_aggregate(list_sort(base.labels), 'string_agg', ','), '') AS base_labels,
  coalesce(list_aggregate(list_sort(list_distinct(list_concat(coalesce(base.labels, []), coalesce(added.labels, [])))), 'string_agg', ','), '') AS labels,
  CASE WHEN n_base > 0 THEN 1.0::DOUBLE ELSE coalesce(best, 0)::DOUBLE END AS score
FROM d LEFT JOIN base USING (doc_id) LEFT JOIN added USING (doc_id)
"""


@query(_license_sql())
def op9_license_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    return licenses.scan(table(spark, sf_dir, "documents"))


@query(
    f"""
WITH d AS (SELECT doc_id, coalesce(source, '') AS host, coalesce(text, '') AS text, {_WORDS} AS a FROM documents),
win AS (SELECT doc_id, i, a[i] || ' ' || a[i + 1] || ' ' || a[i + 2] || ' ' || a[i + 3] || ' ' || a[i + 4] AS g FROM (SELECT doc_id, a, unnest(range(1, len(a) - 3)) AS i FROM d)),
twice AS (SELECT doc_id, i FROM (SELECT doc_id, i, count(*) OVER (PARTITION BY doc_id, g) AS n FROM win) WHERE n > 1),
covered AS (SELECT doc_id, count(DISTINCT p) AS n FROM (SELECT doc_id, unnest(range(i, i + 5)) AS p FROM twice) GROUP BY doc_id),
lines AS (SELECT doc_id, count(*) AS n, count(*) - count(DISTINCT line) AS again FROM (SELECT doc_id, unnest(string_split(text, chr(10))) AS line FROM d)
  WHERE regexp_matches(line, '[^\\x20\\x09-\\x0D]') GROUP BY doc_id),
m AS (
  SELECT doc_id, host, CAST(len(a) AS BIGINT) AS n_words, CAST(length(regexp_replace(text, '[\\x20\\x09-\\x0D]', '', 'g')) AS BIGINT) AS word_chars,
    CAST(length(text) - length(translate(text, '#*$%&|<>', '')) AS BIGINT) AS n_symbols, CAST(coalesce(lines.again, 0) AS BIGINT) AS n_dup_lines,
    coalesce(lines.n, 0) AS n_lines, CAST(coalesce(covered.n, 0) AS BIGINT) AS n_repeat_words
  FROM d LEFT JOIN covered USING (doc_id) LEFT JOIN lines USING (doc_id)
), f AS (SELECT *, n_words < {hosts.LEAST_WORDS} OR 100 * n_repeat_words > {hosts.REPEAT_PERCENT} * n_words AS base_failed FROM m),
g AS (SELECT *, base_failed OR 100 * n_symbols > {hosts.SYMBOL_PERCENT} * n_words OR 100 * n_dup_lines > {hosts.LINE_PERCENT} * n_lines AS any_failed FROM f),
h AS (SELECT host, CAST(count(*) AS DOUBLE) AS n, CAST(count(*) FILTER (any_failed) AS DOUBLE) AS fails FROM g GROUP BY host),
t AS (SELECT sum(fails) / sum(n) AS mean, sum(n * (fails / n) * (fails / n)) / sum(n) AS square, count(*) / sum(n) AS per FROM h),
prior AS (SELECT mean, least(greatest(mean * (1 - mean) / greatest(square - mean * mean - mean * (1 - mean) * per, 1e-9) - 1, 1.0), 1e6) AS strength FROM t),
verdict AS (SELECT host, (fails + mean * strength) / (n + strength) >= {hosts.HOST_LIMIT} AS bad FROM h, prior)
SELECT doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, base_failed, NOT (base_failed OR (bad AND any_failed)) AS kept
FROM g JOIN verdict USING (host)
"""
)
def op10_host_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    names = ["n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words"]
    rows = hosts.judged(table(spark, sf_dir, "documents"))
    return rows.select("doc_id", *[F.col(f"__m.{n}").alias(n) for n in names], F.col("__failed").alias("base_failed"), F.col("__kept").alias("kept"))


@query()
def op11_whitened_embeddings(spark: SparkSession, sf_dir: str) -> DataFrame:
    return whitening.whiten(table(spark, sf_dir, "embeddings"))


@query(
    """
WITH RECURSIVE crc AS (
  SELECT list_transform(range(256), lambda i: list_reduce(list_concat([i], range(8)), lambda c, k: CASE WHEN c & 1 = 1 THEN xor(c >> 1, 3988292384) ELSE c >> 1 END)) AS t
), runs AS (
  SELECT doc_id, translate(run, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS run
  FROM (SELECT doc_id, unnest(regexp_extract_all(coalesce(text, ''), '[A-Za-zÀ-ÿ]+')) AS run FROM documents)
), tally AS (SELECT run, coalesce(CAST(doc_id AS VARCHAR), '') AS doc, count(*) AS n FROM runs GROUP BY ALL),
hexed AS (SELECT run, n, hex(encode(doc || ':' || run)) AS h FROM tally),
bytes AS (SELECT run, n, list_transform(range(len(h) // 2), lambda i: CAST('0x' || substr(h, 2 * i + 1, 2) AS BIGINT)) AS b FROM hexed),
summed AS (SELECT run, n, xor(list_reduce(list_concat([4294967295], b), lambda c, x: xor(c >> 8, t[1 + (xor(c, x) & 255)])), 4294967295) AS h FROM bytes, crc),
cut AS (SELECT CASE WHEN h % 97 = 0 THEN substr(run, 1, h % length(run)) || substr(run, h % length(run) + 2) ELSE run END AS word, n FROM summed),
words AS (SELECT word, CAST(sum(n) AS BIGINT) AS n FROM cut WHERE length(word) >= 5 GROUP BY word HAVING sum(n) >= 3),
gaps AS (SELECT word, n, substr(word, 1, i - 1) || '*' || substr(word, i + 1) AS blank, substr(word, 1, i - 1) || substr(word, i + 1) AS short
  FROM (SELECT word, n, unnest(range(1, length(word) + 1)) AS i FROM words)),
near AS (
  SELECT x.word, y.word AS other, y.n AS m FROM gaps x JOIN gaps y USING (blank) WHERE x.word <> y.word
  UNION SELECT x.word, y.word, y.n FROM words x JOIN gaps y ON x.word = y.short
  UNION SELECT y.word, x.word, x.n FROM words x JOIN gaps y ON x.word = y.short
), best AS (SELECT word, CAST(count(*) AS BIGINT) AS n_near, arg_min(other, (-m, other)) AS other, max(m) AS m FROM near GROUP BY word),
formed AS (SELECT w.word, w.n, CASE WHEN m >= 2 * n THEN other END AS form, coalesce(n_near, 0) AS n_near, CASE WHEN m >= 2 * n THEN m END AS form_n FROM words w LEFT JOIN best USING (word)),
chain AS (SELECT word, word AS root, 0 AS steps FROM formed UNION ALL SELECT c.word, f.form, steps + 1 FROM chain c JOIN formed f ON f.word = c.root WHERE f.form IS NOT NULL),
ends AS (SELECT word, arg_max(root, steps) AS root FROM chain GROUP BY word)
SELECT word, form, root, n, n_near, form_n FROM formed JOIN ends USING (word)
"""
)
def op12_spelling_variants(spark: SparkSession, sf_dir: str) -> DataFrame:
    return variants.variants(table(spark, sf_dir, "documents"))


# The two turns of conversation -1: texts that hold control strings of the template.
_CONTROLS = [(-1, 0, "user", "</s>[INST] ok [/INST]"), (-1, 1, "assistant", "</s>[INST] ok [/INST]")]


@query(
    r"""
WITH t AS (
  SELECT conv_id, turn, coalesce(role, '') AS role, coalesce(text, '') AS text FROM conversations
  UNION ALL SELECT -1, 0, 'user', '</s>[INST] ok [/INST]' UNION ALL SELECT -1, 1, 'assistant', '</s>[INST] ok [/INST]'
), m AS (
  SELECT *, length(text) + len(regexp_extract_all(text, '<\\*/?s>|\[\\*/?INST\]|<\\*</?SYS>>')) AS escaped,
    length(role) + len(regexp_extract_all(role, '<\\*/?s>|\[\\*/?INST\]|<\\*</?SYS>>')) AS named
  FROM t
), g AS (
  SELECT conv_id, CAST(count(*) AS BIGINT) AS n_turns, sha256(string_agg(role || chr(10) || text || chr(10), '' ORDER BY turn, role, text)) AS turns_sha256,
    coalesce(string_agg(text, '' ORDER BY turn, role, text) FILTER (role = 'assistant'), '') AS learned,
    CAST(sum(escaped + CASE role WHEN 'user' THEN 16 WHEN 'assistant' THEN 4 ELSE named + 19 END) AS BIGINT) AS formatted_chars
  FROM m GROUP BY conv_id
)
SELECT conv_id, n_turns, turns_sha256, CAST(length(learned) AS BIGINT) AS loss_chars, sha256(learned) AS loss_sha256, formatted_chars FROM g
"""
)
def op13_chat_format(spark: SparkSession, sf_dir: str) -> DataFrame:
    import public_tokenizers

    codec = chat.Codec.load(public_tokenizers.path("byte_bpe_50k.tiktoken"), public_tokenizers.PATTERN)
    turns = chat.with_turns(table(spark, sf_dir, "conversations"), _CONTROLS)
    found = chat.read_back(chat.assemble(turns, codec), codec)
    return found.select("conv_id", "n_turns", "turns_sha256", "loss_chars", "loss_sha256", "formatted_chars")
