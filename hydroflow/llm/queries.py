"""The registered queries of the numbered operators, and their SQL twins where SQL can express them."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from hydroflow.llm import bpe, chat, ctw, decontaminate, exact_dedup, html_text, mixing, quality, repair, search, simhash, url_filter, warc
from hydroflow.llm.common import table
from hydroflow.operators.positions import null_safe_join
from hydroflow.session import scratch_path, stored

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}
ORACLE: dict[str, str] = {}


def query(sql: str | None = None) -> Callable[[Query], Query]:
    def register(fn: Query) -> Query:
        QUERIES[fn.__name__] = fn
        if sql:
            ORACLE[fn.__name__] = sql
        return fn

    return register


HOST_RULES = [
    ("org", "/", "allow"),
    ("example.org", "/es/", "block"),
    ("example.org", "/en/1", "block"),
    ("com", "/fr/", "allow"),
    ("com", "/de/", "block"),
]
PATTERN_LINES = [
    "||spam-farm.",
    "||link-farm.",
    "||cheap-pills.",
    "||*-casino.",
    "||casino.",
    "||poker.",
    "||xxx.",
    "||porn.",
    "||malware.",
    "||phishing.",
    "/adult/",
    "/gambling/",
    "/warez/",
    "/viagra/",
    "@@/addiction-help/",
]
URL_RULES = [url_filter.Rule.host(*r) for r in HOST_RULES] + [url_filter.Rule.parse(x) for x in PATTERN_LINES]


@query(
    r"""
WITH located AS (SELECT page_id, coalesce(url, '') AS u, strpos(coalesce(url, ''), '://') AS mark FROM pages),
behind AS (SELECT page_id, CASE WHEN mark > 0 THEN substr(u, mark + 3) ELSE '' END AS rest FROM located),
parts AS (
  SELECT page_id,
    translate(regexp_extract(rest, '^[^/?#]*', 0), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS host,
    regexp_extract(rest, '^[^/?#]*([^?#]*)', 1) AS path,
    translate(rest, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS low
  FROM behind),
judged AS (
  SELECT page_id, host, path,
    CASE WHEN (host = 'example.org' OR ends_with(host, '.example.org')) AND starts_with(path, '/en/1') THEN 'example.org/en/1'
      WHEN (host = 'example.org' OR ends_with(host, '.example.org')) AND starts_with(path, '/es/') THEN 'example.org/es/'
      WHEN (host = 'com' OR ends_with(host, '.com')) AND starts_with(path, '/fr/') THEN 'com/fr/'
      WHEN (host = 'com' OR ends_with(host, '.com')) AND starts_with(path, '/de/') THEN 'com/de/'
      WHEN (host = 'org' OR ends_with(host, '.org')) AND starts_with(path, '/') THEN 'org/' END AS rule,
    CASE WHEN low LIKE '%/addiction-help/%' THEN 'allow'
      WHEN regexp_matches(low, '^([^/?#]*[.])?(spam-farm|link-farm|cheap-pills|poker|xxx|porn|malware|phishing)[.]')
        OR regexp_matches(low, '(?s)^([^/?#]*[.])?(.*-)?casino[.]')
        OR regexp_matches(low, '/(adult|gambling|warez|viagra)/') THEN 'block' ELSE 'allow' END AS other
  FROM parts)
SELECT page_id, host, path, rule,
  CASE WHEN rule IN ('org/', 'com/fr/') THEN 'allow' WHEN rule IS NOT NULL THEN 'block' ELSE other END AS verdict
FROM judged"""
)
def op1_url_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Host and path of every page's url, the host rule that fits it, and the verdict."""
    judged = url_filter.filter_urls(table(spark, sf_dir, "pages").select("page_id", "url"), URL_RULES)
    return judged.select("page_id", "judged.host", "judged.path", "judged.rule", "judged.verdict")


@query()
def op2_simhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Fingerprint and component of every document."""
    found = simhash.near_duplicates(table(spark, sf_dir, "documents"))
    return found.select("doc_id", simhash.as_hex(F.col("print")).alias("fingerprint"), "component_id")


_CHECKED = "\\### Assistant: </turn> ok"


@query(
    rf"""
WITH turns AS (
  SELECT conv_id, turn, coalesce(role, '') AS role, coalesce(text, '') AS text FROM conversations
  UNION ALL SELECT * FROM (VALUES (-7::BIGINT, 0::BIGINT, 'user', '{_CHECKED}'), (-7, 1, 'assistant', '{_CHECKED}'))),
written AS (
  SELECT *, length('<|turn|><|text|><|end|>') + 1
    + length(replace(replace(role, '\', '\\'), '<|', '<\|')) + length(replace(replace(text, '\', '\\'), '<|', '<\|')) AS chars
  FROM turns)
SELECT conv_id, count(*) AS n_turns,
  sha256(string_agg(role || chr(10) || text || chr(10), '' ORDER BY turn NULLS FIRST, role, text)) AS turns_sha256,
  coalesce(sum(length(text)) FILTER (role = 'assistant'), 0)::BIGINT AS loss_chars,
  sha256(coalesce(string_agg(text, '' ORDER BY turn NULLS FIRST, role, text) FILTER (role = 'assistant'), '')) AS loss_sha256,
  sum(chars)::BIGINT AS formatted_chars
FROM written GROUP BY conv_id"""
)
def op5_chat_format(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All conversations formatted and read back; digests of the turns and of the text under the loss mask."""
    own = spark.range(2).select(
        F.lit(-7).cast("long").alias("conv_id"),
        F.col("id").alias("turn"),
        F.when(F.col("id") == 0, "user").otherwise("assistant").alias("role"),
        F.lit(_CHECKED).alias("text"),
    )
    turns = table(spark, sf_dir, "conversations").select("conv_id", "turn", "role", "text").unionByName(own)
    parts = turns.select("conv_id", "turn", "role", chat.text_parts(F.col("text")).alias("parts"))
    read = chat.read_back(chat.format_conversations(parts))
    joined = F.array_join(
        F.transform("read_turns", lambda t: F.concat(t["role"], F.lit("\n"), t["text"], F.lit("\n"))), ""
    )
    return read.select(
        "conv_id",
        "n_turns",
        F.sha2(joined.cast("binary"), 256).alias("turns_sha256"),
        F.char_length("learned_text").cast("long").alias("loss_chars"),
        F.sha2(F.col("learned_text").cast("binary"), 256).alias("loss_sha256"),
        "formatted_chars",
    )


@query(
    """
WITH texts AS (SELECT doc_id, coalesce(text, '') AS body FROM documents),
groups AS (SELECT body, max(doc_id) AS keep_id, count(*) AS group_size FROM texts GROUP BY body)
SELECT doc_id, keep_id, group_size, doc_id = keep_id AS kept, sha256(texts.body) AS text_sha256
FROM texts JOIN groups ON texts.body = groups.body"""
)
def op7_exact_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document with the one that stays of its text."""
    found = exact_dedup.find_copies(table(spark, sf_dir, "documents"))
    return found.select("doc_id", "keep_id", "group_size", "kept", "text_sha256")


@query()
def op3_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Quality score of every document."""
    found = quality.score_quality(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))
    return found.select("doc_id", "held_out", "score", "predicted")


@query()
def op4_html(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The visible text of every page."""
    pages = table(spark, sf_dir, "pages").select("page_id", "html")
    return html_text.extract_text(pages).select("page_id", "text", F.char_length("text").alias("n_chars"))


@query(
    """
WITH payloads AS (
  SELECT page_id, strlen(coalesce(html, ''))::BIGINT AS payload_bytes, sha1(coalesce(html, '')) AS payload_digest FROM pages),
kept AS (SELECT payload_digest, payload_bytes, max(page_id) AS keep FROM payloads GROUP BY ALL)
SELECT page_id, payload_bytes, payload_digest,
  CASE WHEN payload_bytes >= 1000 AND page_id <> keep THEN 'revisit' ELSE 'response' END AS record_type,
  CASE WHEN payload_bytes >= 1000 AND page_id <> keep THEN keep END AS refers_to
FROM payloads JOIN kept USING (payload_digest, payload_bytes)"""
)
def op6_warc(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every page written to archives and read back; revisits are resolved by the response that they name."""
    path = scratch_path(spark, "warc")
    warc.write_warc(table(spark, sf_dir, "pages").select("page_id", "url", "html"), path)

    def page(urn: str):
        return F.regexp_extract(urn, "^<urn:page:(.*)>$", 1).try_cast("long")

    records = stored(
        warc.read_warc(spark, path).select(
            page("record_id").alias("page_id"),
            "record_type",
            page("refers_to").alias("refers_to"),
            F.substring_index("stated_digest", ":", -1).alias("stated"),
            F.octet_length("payload").cast("long").alias("payload_bytes"),
            F.sha1("payload").alias("payload_digest"),
        ),
        "warc-records",
    )
    responses = records.filter("record_type = 'response'")
    named = responses.select(
        F.col("page_id").alias("refers_to"), F.col("payload_digest").alias("stated"), "payload_bytes", "payload_digest"
    ).distinct()
    revisits = records.filter("record_type = 'revisit'").select("page_id", "record_type", "refers_to", "stated")
    columns = ["page_id", "payload_bytes", "payload_digest", "record_type", "refers_to"]
    return responses.select(*columns).unionByName(revisits.join(named, ["refers_to", "stated"]).select(*columns))


@query()
def op8_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The documents of a mix with 95 % of the largest entropy over sources and four passes at most."""
    docs = table(spark, sf_dir, "documents").select("doc_id", "source", "text")
    mixed = mixing.mix_sources(docs)
    return mixed.select("doc_id", "source", "mixed.*")


@query()
def op9_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The documents that contain a benchmark item, with the item."""
    found = decontaminate.find_contaminated(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))
    return found.select("doc_id", "item_id", "n_windows", "n_found", "share", "reparameterised")


@query()
def op10_ctw(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Language-model scores of every document."""
    return ctw.score_texts(table(spark, sf_dir, "documents"), depth=ctw.DEPTH)


#: The tokenizer file of the encoding query; any file of its kind can be named instead.
VOCABULARY = "word_bpe_49k.json"


@query()
def op11_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document encoded and decoded again; digests of the ids and of the decoded text."""
    import public_tokenizers

    vocabulary = bpe.read_vocabulary(public_tokenizers.path(VOCABULARY))
    encoded = bpe.encode(table(spark, sf_dir, "documents").select("doc_id", "text"), vocabulary).select("doc_id", "ids")
    return bpe.decode(encoded, vocabulary).select(
        "doc_id",
        F.size("ids").cast("long").alias("n_tokens"),
        F.sha2(F.array_join("ids", " ").cast("binary"), 256).alias("ids_sha256"),
        F.sha2(F.col("decoded").cast("binary"), 256).alias("decoded_sha256"),
    )


@query(
    r"""
WITH own AS (
  SELECT row_number() OVER () AS doc, doc_id,
    regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
      '[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+') AS terms FROM documents),
asked AS (
  SELECT row_number() OVER () AS item, item_id,
    regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
      '[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+') AS terms FROM benchmark),
size AS (SELECT count(*) AS n_docs, sum(len(terms)) AS n_terms FROM own WHERE len(terms) > 0),
held AS (SELECT doc, term, count(*) AS tf FROM (SELECT doc, unnest(terms) AS term FROM own) GROUP BY ALL),
weight AS (
  SELECT term, floor(1000 * ln((2 * n_docs + 2)::DOUBLE / (2 * count(*) + 1)::DOUBLE))::BIGINT AS w
  FROM held, size GROUP BY term, n_docs),
norm AS (SELECT doc, doc_id, (75 + (25 * len(terms) * n_docs) // n_terms)::BIGINT AS m FROM own, size WHERE len(terms) > 0),
wanted AS (SELECT item, item_id, term, count(*) AS times FROM (SELECT item, item_id, unnest(terms) AS term FROM asked) GROUP BY ALL),
scored AS (
  SELECT item, item_id, doc, doc_id, sum(times * w * ((1000000000 * tf) // (1000 * tf + 12 * m)))::BIGINT AS score
  FROM wanted JOIN held USING (term) JOIN weight USING (term) JOIN norm USING (doc) GROUP BY item, item_id, doc, doc_id),
ranked AS (
  SELECT item_id, (row_number() OVER (PARTITION BY item ORDER BY score DESC, doc_id ASC NULLS FIRST))::INTEGER AS rank, doc_id, score
  FROM scored WHERE score > 0)
SELECT item_id, rank, doc_id, score FROM ranked WHERE rank <= 20"""
)
def op12_search(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The twenty best documents for every benchmark item."""
    return search.search(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


def damaged(turns: DataFrame) -> DataFrame:
    """Turns damaged by a hash of conversation and turn: dropped, emptied, cut off, repeated, or given to the user.

    NULLs count as one blank, in the hash as well.
    """

    def shown(name: str):
        return F.coalesce(F.col(name).cast("string"), F.lit(" "))

    hit = F.crc32(F.concat(shown("conv_id"), F.lit(":"), shown("turn")).cast("binary")) % 20
    marked = turns.select("conv_id", "turn", shown("role").alias("role"), shown("text").alias("text"), hit.alias("hit"))
    text = F.when(F.col("hit") == 1, "").when(F.col("hit") == 2, F.translate("text", ".!?", "")).otherwise(F.col("text"))
    times = F.explode(F.when(F.col("hit") == 3, F.array(F.lit(1), F.lit(2))).otherwise(F.array(F.lit(1))))
    return marked.filter("hit <> 0").select(
        "conv_id", "turn", F.when(F.col("hit") == 4, "user").otherwise(F.col("role")).alias("role"), text.alias("text"), times.alias("nth")
    ).drop("nth")


@query(
    r"""
WITH RECURSIVE shown AS (
  SELECT conv_id, turn, coalesce(role, ' ') AS role, coalesce(text, ' ') AS text,
    coalesce(conv_id::VARCHAR, ' ') || ':' || coalesce(turn::VARCHAR, ' ') AS key FROM conversations),
hashed AS (
  SELECT *, xor(list_reduce(list_concat([4294967295::UBIGINT],
      flatten(list_transform(string_split(key, ''), lambda x: [ascii(x)::UBIGINT, 0, 0, 0, 0, 0, 0, 0]))),
    lambda c, e: xor(xor(c, e) >> 1, (xor(c, e) & 1) * 3988292384)), 4294967295::UBIGINT) % 20 AS hit FROM shown),
hurt AS (
  SELECT conv_id, turn, CASE WHEN hit = 4 THEN 'user' ELSE role END AS role,
    CASE WHEN hit = 1 THEN '' WHEN hit = 2 THEN translate(text, '.!?', '') ELSE text END AS text,
    unnest(CASE WHEN hit = 3 THEN [1, 2] ELSE [1] END) AS nth
  FROM hashed WHERE hit <> 0),
placed AS (
  SELECT conv_id, turn, role, text, row_number() OVER (PARTITION BY conv_id ORDER BY turn NULLS FIRST, role, sha256(text)) AS pos,
    rtrim(text, chr(32) || chr(9) || chr(10) || chr(11) || chr(12) || chr(13)) AS core, left(role, 1) AS initial FROM hurt),
judged AS (
  SELECT *, CASE WHEN core = '' THEN 'blank'
      WHEN row_number() OVER (PARTITION BY conv_id, role, text ORDER BY pos) > 1 THEN 'duplicate'
      WHEN right(core, 1) NOT IN ('.', '!', '?') THEN 'truncated' ELSE '' END AS fault,
    lag(initial) OVER (PARTITION BY conv_id ORDER BY pos) AS before FROM placed),
counts AS (
  SELECT conv_id, coalesce(max(turn) - min(turn) + 1 - count(DISTINCT turn), 0)::BIGINT AS gaps, max(pos) AS n,
    count(*) FILTER (fault = 'blank') AS blank, count(*) FILTER (fault = 'duplicate') AS duplicate,
    count(*) FILTER (fault = 'truncated') AS truncated,
    count(*) FILTER (before IS NOT NULL AND before || initial NOT IN ('su', 'ua', 'au')) AS illegal
  FROM judged GROUP BY conv_id),
fill(p, inserts, state, lines) AS (VALUES
  (0, '', 0, []::VARCHAR[]), (1, '', 1, []), (2, '', 2, []), (3, '', 3, []),
  (0, 'I', 2, ['user:']), (1, 'I', 2, ['user:']), (2, 'I', 3, ['assistant:']), (3, 'I', 2, ['user:']),
  (0, 'II', 3, ['user:', 'assistant:']), (1, 'II', 3, ['user:', 'assistant:']),
  (2, 'II', 2, ['assistant:', 'user:']), (3, 'II', 3, ['user:', 'assistant:'])),
act(state, edit, initial, q) AS (VALUES
  (0, 'K', 's', 1), (0, 'K', 'u', 2), (1, 'K', 'u', 2), (2, 'K', 'a', 3), (3, 'K', 'u', 2),
  (0, 'R', '', 2), (1, 'R', '', 2), (2, 'R', '', 3), (3, 'R', '', 2),
  (0, 'D', '', 0), (1, 'D', '', 1), (2, 'D', '', 2), (3, 'D', '', 3)),
move AS (SELECT p, inserts, lines, edit, initial, q FROM fill JOIN act USING (state)),
walk(conv_id, pos, state, best) AS (
  SELECT conv_id, 0::BIGINT, 0, {'cost': 0::BIGINT, 'audit': '', 'lines': []::VARCHAR[]} FROM counts
  UNION ALL
  SELECT w.conv_id, j.pos, m.q, min({
    'cost': w.best.cost + 2 * len(m.inserts) + CASE m.edit WHEN 'D' THEN 3 WHEN 'R' THEN 2 ELSE 0 END
      + CASE WHEN m.edit <> 'D' AND j.fault = 'truncated' THEN 1 ELSE 0 END,
    'audit': w.best.audit || m.inserts || m.edit,
    'lines': w.best.lines || m.lines || CASE m.edit WHEN 'D' THEN [] WHEN 'K' THEN [j.role || ':' || j.text]
      ELSE [CASE m.q WHEN 2 THEN 'user:' ELSE 'assistant:' END || j.text] END})
  FROM walk w JOIN judged j ON j.conv_id IS NOT DISTINCT FROM w.conv_id AND j.pos = w.pos + 1
  JOIN move m ON m.p = w.state
  WHERE (m.edit = 'D' OR j.fault NOT IN ('blank', 'duplicate')) AND (m.edit <> 'K' OR m.initial = j.initial)
  GROUP BY w.conv_id, j.pos, m.q),
ended AS (
  SELECT c.conv_id, min({'cost': best.cost + CASE state WHEN 1 THEN 4 WHEN 2 THEN 2 ELSE 0 END,
    'audit': best.audit || CASE state WHEN 1 THEN 'II' WHEN 2 THEN 'I' ELSE '' END,
    'lines': best.lines || CASE state WHEN 1 THEN ['user:', 'assistant:'] WHEN 2 THEN ['assistant:'] ELSE [] END}) AS best
  FROM walk w JOIN counts c ON c.conv_id IS NOT DISTINCT FROM w.conv_id AND c.n = w.pos GROUP BY c.conv_id),
original AS (SELECT DISTINCT conv_id FROM conversations)
SELECT o.conv_id, coalesce(gaps, 0)::BIGINT AS gaps, coalesce(blank, 0)::BIGINT AS blank, coalesce(duplicate, 0)::BIGINT AS duplicate,
  coalesce(truncated, 0)::BIGINT AS truncated, coalesce(illegal, 0)::BIGINT AS illegal, coalesce(e.best.cost, 0)::BIGINT AS cost,
  coalesce(e.best.audit, '') AS audit, sha256(coalesce(array_to_string(e.best.lines, chr(10)), '')) AS repaired_sha256
FROM original o LEFT JOIN counts c ON c.conv_id IS NOT DISTINCT FROM o.conv_id
LEFT JOIN ended e ON e.conv_id IS NOT DISTINCT FROM o.conv_id"""
)
def op13_repair(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every conversation damaged and repaired: its faults, the cheapest edits, and a digest of what came out."""
    turns = table(spark, sf_dir, "conversations")
    found = repair.repair(damaged(turns))
    numbers = ["gaps", "blank", "duplicate", "truncated", "illegal", "cost"]
    whole = null_safe_join(turns.select("conv_id").distinct(), found.conversations, ["conv_id"], "left")
    whole = null_safe_join(whole, repair.repaired_digests(found), ["conv_id"], "left")
    return whole.select(
        "conv_id",
        *[F.coalesce(F.col(n), F.lit(0)).cast("long").alias(n) for n in numbers],
        F.coalesce("audit", F.lit("")).alias("audit"),
        F.coalesce("sha256", F.sha2(F.lit("").cast("binary"), 256)).alias("repaired_sha256"),
    )
