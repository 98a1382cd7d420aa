"""The queries of this subpackage for the driver, and SQL for those that SQL can express."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidewell.llm import (
    chat, exact_dedup, langid, line_quality, mixing, packing, phrases, secrets, simhash, suffixes, token_files, url_filter, vector_codes,
)
from tidewell.llm._common import spread, table

ORACLE_SQL: dict[str, str] = {
    "op7_chat": r"""
        WITH RECURSIVE e AS (
            SELECT conv_id, turn, role, text, md5(conv_id || ':' || turn) AS m, m[1:1] AS x, m[2:2] AS y,
                   CASE role WHEN 'user' THEN 'call' WHEN 'assistant' THEN 'result' ELSE 'message' END AS kind,
                   CASE role WHEN 'user' THEN conv_id || ':' || (CASE WHEN y = '0' THEN turn - 2 ELSE turn END) WHEN 'assistant' THEN conv_id || ':'
                       || (turn - 1) END AS id
            FROM conversations),
        links AS (SELECT conv_id, id, min(turn) FILTER (kind = 'call') AS call, min(turn) FILTER (kind = 'result') AS result FROM e WHERE id IS NOT
            NULL GROUP BY ALL),
        named AS (
            SELECT conv_id, id, turn, conv_id || ':' || (turn - 2) AS target FROM e WHERE kind = 'call' AND y NOT IN ('5', '6') AND x IN ('0', '1', '2', '3',
                '4', '5', '9')
            UNION ALL SELECT conv_id, id, turn, conv_id || ':' || (turn + 2) FROM e WHERE kind = 'call' AND y NOT IN ('5', '6') AND x IN ('6', '7', '8', '9')),
        edges AS (
            SELECT n.conv_id, n.id, n.target, greatest(n.turn, coalesce(o.result, o.call)) AS due
            FROM named n JOIN links l ON l.conv_id = n.conv_id AND l.id = n.id AND l.call = n.turn JOIN links o ON o.conv_id = n.conv_id AND o.id =
                n.target AND o.call IS NOT NULL),
        reach AS (SELECT conv_id, id, target FROM edges UNION SELECT r.conv_id, r.id, e.target FROM reach r JOIN edges e ON e.conv_id = r.conv_id AND
            e.id = r.target),
        stuck AS (SELECT DISTINCT r.conv_id, r.id FROM reach r WHERE r.id = r.target OR EXISTS (FROM reach o WHERE o.conv_id = r.conv_id AND o.id =
            r.target AND o.target = r.target)),
        free AS (SELECT * FROM edges ANTI JOIN stuck USING (conv_id, id)),
        walk AS (SELECT conv_id, id, target, due, 2 AS depth FROM free UNION SELECT w.conv_id, w.id, f.target, greatest(w.due, f.due), w.depth + 2
            FROM walk w JOIN free f ON f.conv_id = w.conv_id AND f.id = w.target),
        late AS (SELECT conv_id, id, max(due) AS due, max(depth) AS depth FROM walk GROUP BY ALL UNION ALL SELECT conv_id, id, NULL, -1 FROM stuck),
        s AS (
            SELECT e.*, l.call, l.result, t.due AS call_due, coalesce(t.depth, 0) AS call_depth,
                   CASE WHEN kind = 'message' THEN 'message' WHEN e.turn <> (CASE kind WHEN 'call' THEN l.call ELSE l.result END) THEN 'duplicate'
                       WHEN kind = 'call' AND call_depth < 0 THEN 'cycle'
                        WHEN (CASE kind WHEN 'call' THEN l.result ELSE l.call END) IS NOT NULL THEN 'linked' WHEN kind = 'call' THEN 'unanswered' ELSE
                            'orphan' END AS status
            FROM e LEFT JOIN links l USING (conv_id, id) LEFT JOIN late t USING (conv_id, id)),
        d AS (
            SELECT *, (CASE status WHEN 'linked' THEN greatest(call_depth, 0) + CASE kind WHEN 'result' THEN 1 ELSE 0 END WHEN 'unanswered' THEN
                greatest(call_depth, 0) ELSE 0 END)::BIGINT AS depth,
                   CASE WHEN status IN ('linked', 'unanswered') THEN greatest(turn, CASE kind WHEN 'result' THEN call END, call_due) ELSE turn END AS
                       due FROM s)
        SELECT conv_id, turn, row_number() OVER (PARTITION BY conv_id ORDER BY due, depth, turn) - 1 AS position, kind, id, status, depth,
               CASE WHEN kind = 'call' THEN CASE y WHEN '1' THEN 'turn is not integer' WHEN '2' THEN 'missing text' WHEN '3' THEN
                   'unknown parameter extra' WHEN '4' THEN 'unknown tool' WHEN '5' THEN 'arguments are no object' WHEN '6' THEN 'arguments are no object' ELSE '' END END AS problems,
               CASE kind
               WHEN 'call' THEN '{"arguments":' || CASE WHEN y = '5' THEN '[' || turn || ']' WHEN y = '6' THEN 'null' ELSE
                   '{' || CASE WHEN x IN ('0', '1', '2', '3', '4', '5', '9') THEN '"after":"$' || conv_id || ':' || (turn - 2) || '",' ELSE '' END
                       || CASE WHEN x IN ('6', '7', '8', '9') THEN '"also":"$' || conv_id || ':' || (turn + 2) || '",' ELSE '' END
                       || CASE WHEN y = '3' THEN '"extra":true,' ELSE '' END || CASE WHEN y = '2' THEN '' ELSE '"text":' || to_json(text) || ',' END
                       || '"turn":' || CASE WHEN y = '1' THEN '"' || turn || '"' ELSE turn::VARCHAR END || '}' END
                   || ',"id":"' || id || '","name":"' || CASE WHEN y = '4' THEN 'lookup' ELSE 'reply' END || CASE WHEN y = '6' THEN '","raw":' || to_json('{"turn": ' || turn) || ',"role":"user","type":"call"}' ELSE '","role":"user","type":"call"}' END
               WHEN 'result' THEN '{"content":' || to_json(text) || ',"id":"' || id || '","role":"assistant","type":"result"}'
               ELSE '{"content":' || to_json(text) || ',"role":' || to_json(role) || '}' END AS json
        FROM d""",
    "op10_exact_dedup": r"""
        WITH t AS (SELECT doc_id, regexp_replace(coalesce(text, ''), '[\x20\x09-\x0D]+', ' ', 'g') AS s FROM documents),
             g AS (SELECT s, min(doc_id) AS keep_id, count(*) AS group_size FROM t GROUP BY s)
        SELECT doc_id, keep_id, group_size, doc_id = keep_id AS kept, sha256(s) AS text_sha256 FROM t JOIN g USING (s)""",
}

#: The rules of ``op11_url_filter``.
RULES = (("block", "net", "/"), ("allow", "example.net", "/en/"), ("block", "example.com", "/de/"), ("allow", "org", "/fr/"))

ORACLE_SQL |= {
    "op11_url_filter": url_filter.sql("pages", RULES), "op12_vector_codes": vector_codes.sql("embeddings", 64),
    "op13_phrases": phrases.sql("documents"),
}


def op1_token_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    manifest = token_files.write_tokens(table(spark, sf_dir, "documents"))
    return token_files.read_tokens(spark, manifest).select(
        "doc_id", "start", (F.length("ids") / 4).cast("long").alias("n_tokens"), F.crc32("ids").alias("ids_crc32"),
    )


def op2_simhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = simhash.near_classes(spread(table(spark, sf_dir, "documents")))
    return found.select("doc_id", F.lower(F.lpad(F.hex("fp"), 16, "0")).alias("fingerprint"), "component_id")


def op3_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    mixed = mixing.mix(table(spark, sf_dir, "documents"))
    return mixed.select("doc_id", "size", "source_size", "target", (F.col("copies") * F.col("size")).alias("taken"))


def op4_suffixes(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = suffixes.repeats(spread(table(spark, sf_dir, "documents")))
    words = F.aggregate("spans", F.lit(0).cast("long"), lambda n, s: n + s["end"] - s["start"])
    return found.select(
        "doc_id", F.size("spans").alias("n_spans"), words.alias("repeated_words"),
        F.array_join(F.transform("spans", lambda s: F.concat_ws(":", s["start"], s["end"])), ",").alias("spans"),
        F.array_distinct(F.transform("spans", lambda s: s["other"])).alias("others"),
    )


def op5_line_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    judged = line_quality.judge(spread(table(spark, sf_dir, "documents")))
    return judged.select(
        "doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", "kept",
        "removed_words",
    )


def op6_langid(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = spread(table(spark, sf_dir, "documents"))
    learned = langid.learn(docs.filter(~langid.held_out()).select("text", "lang"))
    return langid.identify(docs, learned).select("doc_id", langid.held_out().alias("held_out"), "lang_pred", "score", "rejected")


#: The tool that the user turns of ``conversations`` call; ``after`` and ``also`` may refer to other calls.
REPLY: chat.Schemas = {
    "reply": {"text": ("string", True), "turn": ("integer", True), "after": ("string", False), "also": ("string", False)}
}


def _tool_events(conversations: DataFrame) -> DataFrame:
    """Every row of ``conversations`` as an event. The table holds no tool calls, so each user turn is taken as a call and
    the assistant's next turn as its result; two digits of a row's MD5 say what is odd about a call: a reference back
    (0 to 5), ahead (6 to 8) or both (9), so that chains and cycles come about; and the identifier of the call before (0),
    a turn of the wrong type (1), no text (2), a parameter too many (3), another tool (4), no object (5), arguments that break
    off (6), a turn with a fraction of zero (7)."""
    user, assistant = F.col("role") == "user", F.col("role") == "assistant"
    at = lambda t: F.concat_ws(":", F.col("conv_id").cast("string"), t.cast("string"))
    turn, digits = F.col("turn"), F.md5(at(F.col("turn")).cast("binary"))
    x, y = F.substring(digits, 1, 1), F.substring(digits, 2, 1)
    fields = {
        "after": F.when(
            x.isin(*"0123459"), F.concat(F.lit("$"), at(turn - 2)),
        ), "also": F.when(x.isin(*"6789"), F.concat(F.lit("$"), at(turn + 2))),
        "extra": F.when(y == "3", True), "text": F.when(y != "2", F.col("text")),
    }
    with_turn = lambda t: F.to_json(F.struct(*(c.alias(n) for n, c in fields.items()), t.alias("turn")))
    given = F.when(y == "5", F.concat(F.lit("["), turn, F.lit("]"))).when(y == "6", F.concat(F.lit('{"turn": '), turn)).when(
        y == "1", with_turn(turn.cast("string")),
    ).when(y == "7", with_turn(turn.cast("decimal(20,1)")))
    given = given.otherwise(with_turn(turn))
    return conversations.select(
        "conv_id", turn.cast("long").alias("turn"), F.lit(0).cast("long").alias("part"), "role", F.when(user, "call").when(assistant, "result").otherwise("message").alias("kind"),
        F.when(
            user, at(F.when(y == "0", turn - 2).otherwise(turn)),
        ).when(assistant, at(turn - 1)).alias("id"), F.when(user, F.when(y == "4", "lookup").otherwise("reply")).alias("name"),
        F.when(user, given).alias("arguments"), F.when(~F.coalesce(user, F.lit(False)), F.col("text")).alias("content"),
    )


def op7_chat(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = chat.format_events(_tool_events(table(spark, sf_dir, "conversations")), REPLY)
    return found.select(
        "conv_id", "turn", "position", "kind", "id", "status", "depth",
        F.array_join("problems", "; ").alias("problems"), "json",
    )


def op8_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    pieces = packing.pack(spread(table(spark, sf_dir, "documents")))
    return pieces.select("doc_id", "start", "length", F.crc32("ids").alias("ids_crc32"), "doc_tokens", "sequence_id", "offset")


def op9_secrets(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = spread(table(spark, sf_dir, "documents"))
    found = secrets.find_secrets(docs, secrets.learn_identifiers(docs))
    n = lambda kind: F.size(F.filter("spans", lambda s: s["kind"] == kind)).cast("long").alias(f"n_{kind}")
    listed = lambda spans: F.array_join(F.transform(spans, lambda s: F.concat_ws(":", s["kind"], s["start"], s["end"])), ",")
    base = F.filter("spans", lambda s: s["kind"] != "novel")
    return found.select(
        "doc_id", n("assign"), n("access"), n("hex"), F.sha2(listed(base), 256).alias("base_sha256"),
        listed(F.col("spans")).alias("spans"), n("novel"),
    )


def op10_exact_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return exact_dedup.exact_classes(spread(table(spark, sf_dir, "documents"))).select(
        "doc_id", "keep_id", "group_size", "kept", "text_sha256",
    )


def op11_url_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    return url_filter.judge(table(spark, sf_dir, "pages"), RULES).select("page_id", "host", "path", "rule", "verdict")


def op12_vector_codes(spark: SparkSession, sf_dir: str) -> DataFrame:
    coded, books = vector_codes.compress(table(spark, sf_dir, "embeddings"))
    return coded.select(
        "vec_id", F.lower(F.hex("code")).alias("code"), "error", "label_error", F.lit(vector_codes.fingerprint(books)).alias("codebooks_sha256"),
    )


def op13_phrases(spark: SparkSession, sf_dir: str) -> DataFrame:
    return phrases.collocations(table(spark, sf_dir, "documents"))


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    f.__name__: f for f in (
        op1_token_files, op2_simhash, op3_mixing, op4_suffixes, op5_line_quality, op6_langid, op7_chat, op8_packing,
        op9_secrets, op10_exact_dedup, op11_url_filter, op12_vector_codes, op13_phrases,
    )
}
