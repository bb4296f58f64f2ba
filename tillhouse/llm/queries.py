"""One query per operator over its whole table, and its SQL where SQL can express it."""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tillhouse.llm import bpe, chat_quotes, conversation_repair, filter_audit, html_text, pii, secret_scan, simhash, substrings, toxicity, warc
from tillhouse.llm.decontaminate import contamination
from tillhouse.llm.exact_dedup import exact_groups
from tillhouse.llm.frames import documents, table


RANKS = public_tokenizers.path("byte_bpe_multi_50k.tiktoken")


def op1_substring_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return substrings.repeats(documents(spark, sf_dir))


def op2_chat_quotes(spark: SparkSession, sf_dir: str) -> DataFrame:
    return chat_quotes.reply_ordered(table(spark, sf_dir, "conversations"))


def op3_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = documents(spark, sf_dir).select("doc_id", "text")
    found = toxicity.scored(docs, toxicity.train(docs, table(spark, sf_dir, "labels")), carry=["doc_id"])
    return found.select(
        "doc_id",
        toxicity.held_out(F.col("doc_id")).alias("held_out"),
        "score",
        (F.col("score") >= toxicity.THRESHOLD).cast("int").alias("predicted"),
    )


def op4_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = contamination(documents(spark, sf_dir), table(spark, sf_dir, "benchmark"), carry=["doc_id"])
    return found.select(
        "doc_id",
        "leak.n_words",
        "leak.n_hit",
        F.size("leak.items").cast("long").alias("n_items"),
        F.sha2(F.concat_ws(",", "leak.items"), 256).alias("items_sha256"),
        (F.col("leak.n_hit") > 0).alias("contaminated"),
    )


def op5_byte_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    return bpe.encoded(documents(spark, sf_dir), RANKS, public_tokenizers.PATTERN, carry=["doc_id"], ids=False)


def op7_warc(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Lengths and digests of responses are taken from the payloads that were read back, of revisits from their headers."""
    back = warc.read_archive(spark, warc.page_archive(table(spark, sf_dir, "pages")))
    number = lambda c: F.substring_index(c, ":", -1).try_cast("long")
    response = F.col("record_type") == "response"
    return back.select(
        number("record_id").alias("page_id"),
        F.when(response, F.octet_length("payload")).otherwise(F.col("payload_length")).cast("long").alias("payload_bytes"),
        F.when(response, F.sha1("payload")).otherwise(F.col("payload_digest")).alias("payload_digest"),
        "record_type",
        number("refers_to").alias("refers_to"),
    )


def op8_secrets(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = secret_scan.secret_spans(documents(spark, sf_dir), carry=["doc_id"])
    base = F.filter("spans", lambda s: s["kind"] != "novel")
    count = lambda kind: F.size(F.filter("spans", lambda s: s["kind"] == kind)).cast("long")
    return found.select(
        "doc_id",
        *(count(kind).alias(f"n_{kind}") for kind in ("assign", "access", "hex")),
        F.sha2(secret_scan.listed(base), 256).alias("base_sha256"),
        secret_scan.listed(F.col("spans")).alias("spans"),
    )


def op9_html_extraction(spark: SparkSession, sf_dir: str) -> DataFrame:
    pages = table(spark, sf_dir, "pages").select("page_id", "url", "html")
    found = html_text.extracted(pages, html_text.train(pages), carry=["page_id", "url"])
    return found.withColumn("n_chars", F.char_length("text").cast("long"))


def op10_simhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = simhash.near_groups(documents(spark, sf_dir))
    return found.select("doc_id", F.lower(F.lpad(F.hex("fp"), 16, "0")).alias("fingerprint"), "component_id")


def op6_exact_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = documents(spark, sf_dir).select("doc_id", "text")
    docs = docs.withColumn("text_sha256", F.sha2(F.coalesce("text", F.lit("")), 256))
    return exact_groups(docs, ["text_sha256"]).drop("n_same")


def op11_conversation_repair(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = table(spark, sf_dir, "conversations")
    return conversation_repair.report(conversation_repair.edited(conversation_repair.damaged(rows)), rows)


def op12_filter_audit(spark: SparkSession, sf_dir: str) -> DataFrame:
    counts = filter_audit.masks(documents(spark, sf_dir), table(spark, sf_dir, "labels"))
    return filter_audit.interactions(counts)


def op13_pii(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = pii.private_spans(documents(spark, sf_dir), carry=["doc_id"])
    base = F.filter("spans", lambda s: s["kind"].isin(pii.KINDS))
    count = lambda kind: F.size(F.filter("spans", lambda s: s["kind"] == kind)).cast("long")
    return found.select(
        "doc_id",
        *(count(kind).alias(f"n_{kind}") for kind in pii.KINDS),
        F.sha2(secret_scan.listed(base), 256).alias("base_sha256"),
        secret_scan.listed(F.col("spans")).alias("spans"),
    )


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    "op1_substring_dedup": op1_substring_dedup,
    "op2_chat_quotes": op2_chat_quotes,
    "op3_toxicity": op3_toxicity,
    "op4_decontamination": op4_decontamination,
    "op5_byte_bpe": op5_byte_bpe,
    "op6_exact_dedup": op6_exact_dedup,
    "op7_warc": op7_warc,
    "op8_secrets": op8_secrets,
    "op9_html_extraction": op9_html_extraction,
    "op10_simhash": op10_simhash,
    "op11_conversation_repair": op11_conversation_repair,
    "op12_filter_audit": op12_filter_audit,
    "op13_pii": op13_pii,
}

_UPPER, _LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"

ORACLE: dict[str, str] = {
    "op1_substring_dedup": r"""
        WITH d AS (SELECT row_number() OVER () AS id, doc_id, regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') AS w FROM documents),
        win AS (
            SELECT id, doc_id, i, md5(array_to_string(w[i : i + 49], ' ')) AS body
            FROM d, LATERAL (SELECT unnest(generate_series(1, len(w) - 49)) AS i) WHERE len(w) >= 50
        ), low AS (SELECT body, min(doc_id) AS least FROM win GROUP BY body HAVING min(doc_id) < max(doc_id)),
        gone AS (SELECT id, i FROM win JOIN low USING (body) WHERE least < doc_id),
        pos AS (SELECT DISTINCT id, unnest(generate_series(i, i + 49)) AS i FROM gone),
        word AS (SELECT id, unnest(w) AS word, generate_subscripts(w, 1) AS i FROM d WHERE id IN (SELECT id FROM pos)),
        kept AS (
            SELECT id, string_agg(word, ' ' ORDER BY i) FILTER (pos.i IS NULL) AS body, count(pos.i) AS n
            FROM word LEFT JOIN pos USING (id, i) GROUP BY id
        )
        SELECT doc_id, len(w)::BIGINT AS n_words, coalesce(n, 0)::BIGINT AS n_removed,
            sha256(CASE WHEN n IS NULL THEN array_to_string(w, ' ') ELSE coalesce(body, '') END) AS kept_sha256
        FROM d LEFT JOIN kept USING (id)
    """,
    "op2_chat_quotes": r"""
        WITH RECURSIVE m AS (SELECT *, row_number() OVER () AS id FROM conversations),
        s AS (SELECT *, string_split(regexp_replace(coalesce(text, ''), '\r\n?', chr(10), 'g'), chr(10)) AS lines FROM m),
        l AS (SELECT id, conv_id, turn, unnest(lines) AS line, generate_subscripts(lines, 1) AS i FROM s),
        pre AS (SELECT *, regexp_extract(line, '^(?:[ ]{0,3}>)+[ ]?') AS prefix FROM l),
        lev AS (SELECT *, length(prefix) - length(replace(prefix, '>', '')) AS level, substring(line, length(prefix) + 1) AS body FROM pre),
        chg AS (SELECT *, CASE WHEN level <> lag(level) OVER (PARTITION BY id ORDER BY i) THEN 1 ELSE 0 END AS c FROM lev),
        grp AS (SELECT *, sum(c) OVER (PARTITION BY id ORDER BY i) AS number FROM chg),
        pas AS (SELECT id, conv_id, turn, number, level, string_agg(body, chr(10) ORDER BY i) AS body FROM grp GROUP BY ALL),
        own AS (SELECT id, conv_id, turn, string_agg(body, chr(10) ORDER BY number) AS body FROM pas WHERE level = 0 GROUP BY ALL),
        part AS (
            SELECT id, conv_id, turn, number, level, unnest(string_split(body, chr(10)) ||
                string_split(regexp_replace(body, '([.!?])[ \t\r]+', '\1' || chr(10), 'g'), chr(10))) AS body
            FROM pas
        ), unit AS (
            SELECT conv_id, turn, body FROM own UNION ALL SELECT conv_id, turn, body FROM pas WHERE level = 0
            UNION ALL SELECT conv_id, turn, body FROM part WHERE level = 0
        ), said AS (
            SELECT conv_id, lower(trim(regexp_replace(body, '[ \t\r\n]+', ' ', 'g'))) AS body, min(turn) AS source
            FROM unit WHERE conv_id IS NOT NULL AND turn IS NOT NULL GROUP BY ALL
        ), want AS (
            SELECT 0 AS rank, * FROM pas WHERE level > 0 UNION ALL SELECT 1, * FROM part WHERE level > 0
        ), met AS (
            SELECT id, number, level, rank, source FROM want w JOIN said ON w.conv_id = said.conv_id AND source < w.turn
                AND said.body = lower(trim(regexp_replace(w.body, '[ \t\r\n]+', ' ', 'g'))) AND said.body <> ''
        ), best AS (
            SELECT id, number, level, source FROM met QUALIFY row_number() OVER (PARTITION BY id, number ORDER BY rank, source DESC) = 1
        ), answer AS (
            SELECT id, first(source ORDER BY level, source DESC) AS parent, count(*) AS n_linked FROM best GROUP BY id
        ), up AS (SELECT conv_id, turn, min(parent) AS parent FROM m JOIN answer USING (id) GROUP BY ALL),
        walk AS (
            SELECT conv_id, turn, parent AS root, 1 AS depth FROM up
            UNION ALL SELECT w.conv_id, w.turn, u.parent, w.depth + 1 FROM walk w JOIN up u ON u.conv_id = w.conv_id AND u.turn = w.root
        ), thread AS (SELECT conv_id, turn, first(root ORDER BY depth DESC) AS root, max(depth) AS depth FROM walk GROUP BY ALL),
        q AS (SELECT id, count(*) FILTER (level > 0) AS n_quotes FROM pas GROUP BY id),
        r AS (
            SELECT m.conv_id, m.turn, m.role, regexp_replace(coalesce(own.body, ''), '^[ \t\r\n]+|[ \t\r\n]+$', '', 'g') AS text,
                a.parent AS parent_turn, coalesce(t.root, a.parent, m.turn) AS root_turn,
                CASE WHEN a.parent IS NULL THEN 0 ELSE coalesce(t.depth, 0) + 1 END::BIGINT AS depth,
                coalesce(q.n_quotes, 0)::BIGINT AS n_quotes, coalesce(a.n_linked, 0)::BIGINT AS n_linked
            FROM m LEFT JOIN own USING (id) LEFT JOIN answer a USING (id) LEFT JOIN q USING (id)
                LEFT JOIN thread t ON t.conv_id = m.conv_id AND t.turn = a.parent
        )
        SELECT *, '<|' || coalesce(role, '') || '|>' || chr(10) || text AS chat, row_number() OVER (PARTITION BY conv_id
            ORDER BY root_turn NULLS FIRST, depth, turn NULLS FIRST, role NULLS FIRST, text NULLS FIRST) - 1 AS position
        FROM r
    """,
    "op4_decontamination": rf"""
        WITH d AS (
            SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), '{_UPPER}', '{_LOWER}'), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w
            FROM documents
        ), b AS (
            SELECT item_id, regexp_extract_all(translate(coalesce(text, ''), '{_UPPER}', '{_LOWER}'), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w
            FROM benchmark
        ), bw AS (
            SELECT DISTINCT item_id, least(len(w), 10) AS n, array_to_string(w[i : i + least(len(w), 10) - 1], ' ') AS body
            FROM b, LATERAL (SELECT unnest(generate_series(1, greatest(len(w) - 9, 1))) AS i) WHERE len(w) > 0
        ), dw AS (
            SELECT doc_id, i, s.n, array_to_string(w[i : i + s.n - 1], ' ') AS body
            FROM d, (SELECT DISTINCT n FROM bw) s, LATERAL (SELECT unnest(generate_series(1, len(w) - s.n + 1)) AS i)
            WHERE len(w) >= s.n
        ), hits AS (SELECT doc_id, i, dw.n, item_id FROM dw JOIN bw ON dw.n = bw.n AND dw.body = bw.body
        ), covered AS (
            SELECT doc_id, count(DISTINCT p) AS n_hit
            FROM hits, LATERAL (SELECT unnest(generate_series(i, i + n - 1)) AS p) GROUP BY doc_id
        ), listed AS (
            SELECT doc_id, count(DISTINCT item_id) AS n_items, string_agg(DISTINCT item_id::VARCHAR, ',' ORDER BY item_id::VARCHAR) AS ids
            FROM hits GROUP BY doc_id
        )
        SELECT d.doc_id, len(w)::BIGINT AS n_words, coalesce(n_hit, 0)::BIGINT AS n_hit, coalesce(n_items, 0)::BIGINT AS n_items,
            sha256(coalesce(ids, '')) AS items_sha256, coalesce(n_hit, 0) > 0 AS contaminated
        FROM d LEFT JOIN covered USING (doc_id) LEFT JOIN listed USING (doc_id)
    """,
    "op7_warc": """
        WITH p AS (SELECT page_id, coalesce(html, '') AS body FROM pages),
        g AS (SELECT *, max(page_id) OVER (PARTITION BY body) AS last, strlen(body) >= 1000 AND page_id <> max(page_id) OVER (PARTITION BY body) AS again FROM p)
        SELECT page_id, strlen(body)::BIGINT AS payload_bytes, sha1(body) AS payload_digest,
            CASE WHEN again THEN 'revisit' ELSE 'response' END AS record_type, CASE WHEN again THEN last END AS refers_to
        FROM g
    """,
    "op6_exact_dedup": """
        SELECT doc_id, max(doc_id) OVER g AS keep_id, count(*) OVER g AS group_size,
            doc_id = max(doc_id) OVER g AS kept, sha256(coalesce(text, '')) AS text_sha256
        FROM documents WINDOW g AS (PARTITION BY coalesce(text, ''))
    """,
    "op11_conversation_repair": r"""
        WITH RECURSIVE crc AS (
            SELECT list(v ORDER BY i) AS t FROM (
                SELECT i, list_reduce(list_concat([i::BIGINT], range(8)), lambda c, k: CASE WHEN c & 1 = 1 THEN xor(c >> 1, 3988292384) ELSE c >> 1 END) AS v
                FROM range(256) r(i))
        ), raw AS (
            SELECT conv_id, turn, coalesce(role, ' ') AS role, coalesce(text, ' ') AS text,
                list_transform(string_split(concat(coalesce(conv_id::VARCHAR, ' '), ':', coalesce(turn::VARCHAR, ' ')), ''), lambda ch: unicode(ch)::BIGINT) AS bytes
            FROM conversations
        ), hit AS (
            SELECT raw.*, xor(list_reduce(list_concat([4294967295::BIGINT], bytes), lambda c, b: xor(c >> 8, t[(xor(c, b) & 255) + 1])), 4294967295) % 20 AS kind
            FROM raw, crc
        ), harmed AS (
            SELECT conv_id, turn, CASE WHEN kind = 4 THEN 'user' ELSE role END AS role,
                CASE kind WHEN 1 THEN '' WHEN 2 THEN translate(text, '.!?', '') ELSE text END AS text,
                unnest(CASE WHEN kind = 3 THEN [0, 1] ELSE [0] END) AS again
            FROM hit WHERE kind <> 0
        ), placed AS (
            SELECT *, row_number() OVER w AS n, left(role, 1) AS initial, lag(left(role, 1)) OVER w AS before,
                right(rtrim(text, chr(32) || chr(9) || chr(10) || chr(11) || chr(12) || chr(13)), 1) AS last
            FROM harmed WINDOW w AS (PARTITION BY conv_id ORDER BY turn NULLS FIRST, role, sha256(text))
        ), m AS (
            SELECT *, CASE WHEN last = '' THEN 'b' WHEN row_number() OVER (PARTITION BY conv_id, role, text ORDER BY n) > 1 THEN 'd' WHEN last NOT IN ('.', '!', '?') THEN 't' ELSE '' END AS fault FROM placed
        ), steps(first, last, letter, role, fee) AS (
            VALUES ('', 's', 'K', 's', 0), ('', 'u', 'K', 'u', 0), ('s', 'u', 'K', 'u', 0), ('u', 'a', 'K', 'a', 0), ('a', 'u', 'K', 'u', 0),
                ('', 'u', 'R', NULL, 3), ('s', 'u', 'R', NULL, 3), ('u', 'a', 'R', NULL, 3), ('a', 'u', 'R', NULL, 3)
        ), adds(first, last, letters, body) AS (
            VALUES ('', '', '', []::VARCHAR[]), ('s', 's', '', []), ('u', 'u', '', []), ('a', 'a', '', []),
                ('', 'u', 'I', ['user:']), ('s', 'u', 'I', ['user:']), ('u', 'a', 'I', ['assistant:']), ('a', 'u', 'I', ['user:']),
                ('', 'a', 'II', ['user:', 'assistant:']), ('s', 'a', 'II', ['user:', 'assistant:']),
                ('u', 'u', 'II', ['assistant:', 'user:']), ('a', 'a', 'II', ['user:', 'assistant:'])
        ), walk AS (
            SELECT conv_id, 0::BIGINT AS n, ''::VARCHAR AS state, 0::BIGINT AS cost, ''::VARCHAR AS audit, []::VARCHAR[] AS body
            FROM (SELECT DISTINCT conv_id FROM m)
            UNION ALL
            SELECT conv_id, n, state, cost, audit, body FROM (
                SELECT conv_id, n, state, cost, audit, body, row_number() OVER (PARTITION BY conv_id, state ORDER BY cost, audit) AS best FROM (
                    SELECT w.conv_id, m.n, w.state, w.cost + 4 AS cost, w.audit || 'D' AS audit, w.body
                    FROM walk w JOIN m ON m.conv_id IS NOT DISTINCT FROM w.conv_id AND m.n = w.n + 1
                    UNION ALL
                    SELECT w.conv_id, m.n, s.last, w.cost + 3 * length(a.letters) + s.fee + CASE WHEN m.fault = 't' THEN 3 ELSE 0 END,
                        w.audit || a.letters || s.letter,
                        list_concat(list_concat(w.body, a.body), [concat(CASE WHEN s.letter = 'K' THEN m.role WHEN s.last = 'u' THEN 'user' ELSE 'assistant' END, ':', m.text)])
                    FROM walk w JOIN m ON m.conv_id IS NOT DISTINCT FROM w.conv_id AND m.n = w.n + 1
                        JOIN adds a ON a.first = w.state JOIN steps s ON s.first = a.last AND (s.letter = 'R' OR s.role = m.initial)
                    WHERE m.fault NOT IN ('b', 'd')
                )
            ) WHERE best = 1
        ), done AS (
            SELECT w.conv_id, cost + 3 * length(letters) AS cost, audit || letters AS audit, list_concat(w.body, a.body) AS body
            FROM walk w JOIN (SELECT conv_id, max(n) AS n FROM m GROUP BY ALL) e ON e.conv_id IS NOT DISTINCT FROM w.conv_id AND e.n = w.n
                JOIN adds a ON a.first = w.state AND a.last IN ('', 'a')
            QUALIFY row_number() OVER (PARTITION BY w.conv_id ORDER BY cost + 3 * length(letters), audit || letters) = 1
        ), counted AS (
            SELECT conv_id, coalesce(max(turn) - min(turn) + 1 - count(DISTINCT turn), 0) AS gaps, count(*) FILTER (fault = 'b') AS blank,
                count(*) FILTER (fault = 'd') AS duplicate, count(*) FILTER (fault = 't') AS truncated,
                count(*) FILTER (n > 1 AND before || initial NOT IN ('su', 'ua', 'au')) AS illegal
            FROM m GROUP BY conv_id
        )
        SELECT o.conv_id, coalesce(gaps, 0)::BIGINT AS gaps, coalesce(blank, 0) AS blank, coalesce(duplicate, 0) AS duplicate,
            coalesce(truncated, 0) AS truncated, coalesce(illegal, 0) AS illegal, coalesce(cost, 0)::BIGINT AS cost, coalesce(audit, '') AS audit,
            sha256(coalesce(array_to_string(body, chr(10)), '')) AS repaired_sha256
        FROM (SELECT DISTINCT conv_id FROM conversations) o LEFT JOIN counted c ON c.conv_id IS NOT DISTINCT FROM o.conv_id
            LEFT JOIN done d ON d.conv_id IS NOT DISTINCT FROM o.conv_id
    """,
    "op12_filter_audit": r"""
        WITH d AS (
            SELECT doc_id, coalesce(lang, '') AS part, coalesce(text, '') AS text, regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') AS w,
                min(doc_id) OVER (PARTITION BY coalesce(text, '')) AS least
            FROM documents
        ), l AS (SELECT doc_id, max(quality) = 1 AS good, max(toxic) = 1 AS toxic FROM labels GROUP BY doc_id),
        f AS (
            SELECT part, coalesce(good, false) AS good, coalesce(toxic, false) AS toxic, [
                len(w) < 200, 100 * len(list_distinct(w)) < 50 * len(w),
                100 * length(regexp_replace(text, '[^A-Z]+', '', 'g')) > 3 * length(text),
                regexp_matches(text, '[#$%&*|]'), coalesce(doc_id > least, false)] AS fails
            FROM d LEFT JOIN l USING (doc_id)
        ), m AS (SELECT part, fails, good, toxic, count(*) AS n FROM f GROUP BY ALL),
        s AS (SELECT unnest(['A', 'B', 'C', 'D', 'E']) AS x, unnest([1, 2, 3, 4, 5]) AS k),
        p AS (
            SELECT a.x || b.x || c.x || d.x || e.x AS filter_order, [a.k, b.k, c.k, d.k, e.k] AS ks
            FROM s a, s b, s c, s d, s e
            WHERE len(list_distinct([a.k, b.k, c.k, d.k, e.k])) = 5
        ), run AS (
            SELECT part, filter_order, step, n, good, toxic, ks[step] AS k, fails[ks[step]] AS here,
                len(list_filter(ks[1 : step - 1], lambda j: fails[j])) > 0 AS gone, len(list_filter(fails, lambda b: b)) = 1 AS lone
            FROM m, p, (SELECT unnest([1, 2, 3, 4, 5]) AS step)
        ), t AS (
            SELECT part, filter_order, step, k, coalesce(sum(n) FILTER (NOT here AND NOT gone), 0) AS kept, coalesce(sum(n) FILTER (here AND NOT gone), 0) AS removed,
                coalesce(sum(n) FILTER (here AND gone), 0) AS redundant, coalesce(sum(n) FILTER (here AND lone), 0) AS unique_fails,
                coalesce(sum(n) FILTER (here AND NOT gone AND good), 0) AS good_lost, coalesce(sum(n) FILTER (here AND NOT gone AND toxic), 0) AS toxic_lost
            FROM run GROUP BY ALL
        )
        SELECT part, filter_order, step, substr(filter_order, step, 1) AS filter, kept::BIGINT AS kept, removed::BIGINT AS removed, redundant::BIGINT AS redundant,
            unique_fails::BIGINT AS unique_fails, good_lost::BIGINT AS good_lost, toxic_lost::BIGINT AS toxic_lost,
            (sum(removed) OVER (PARTITION BY part, k))::BIGINT AS shapley
        FROM t
    """,
}
