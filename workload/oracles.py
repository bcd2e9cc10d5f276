"""SQL texts for the registered queries, written independently of the operators."""

from __future__ import annotations

from workload.views import cte

HISTORY = cte("deliveries") + """, history AS (
  SELECT * EXCLUDE (place) FROM (SELECT *, row_number() OVER (PARTITION BY event_id
    ORDER BY ingested_at DESC, kafka_timestamp DESC, kafka_partition DESC, kafka_offset DESC)
    AS place FROM deliveries) WHERE place = 1)"""

CURRENT = HISTORY + """, state AS (
  SELECT * EXCLUDE (place) FROM (SELECT *, row_number() OVER (PARTITION BY customer_id, event_type
    ORDER BY occurred_at DESC, ingested_at DESC, kafka_timestamp DESC, kafka_partition DESC,
    kafka_offset DESC, event_id DESC) AS place FROM history) WHERE place = 1)"""

GOLD_COLUMNS = """customer_id, date_trunc('day', occurred_at) AS event_day, currency,
  count(event_id) AS event_count, sum(amount) AS total, sum(amount) / count(amount) AS mean"""

GOLD = HISTORY + f""", gold AS (
  SELECT {GOLD_COLUMNS} FROM history GROUP BY customer_id, date_trunc('day', occurred_at), currency)
"""

DELIVERY_COLUMNS = """event_id, event_type, customer_id, occurred_at,
  CAST(amount AS DOUBLE) AS amount, currency, md5(document_text) AS document_md5, schema_version,
  kafka_topic, kafka_partition, kafka_offset, kafka_timestamp, ingested_at"""

# Contract checks on JSON text. `place` is the position of a field in the list of failures.
JUDGED = cte("deliveries", "messages") + r""", parsed AS (
  SELECT *, CASE WHEN json_valid(value) THEN CAST(value AS JSON) END AS doc FROM messages),
fields AS (
  SELECT *, coalesce(json_type(doc) = 'OBJECT', false) AS is_object,
    CASE WHEN json_type(doc) = 'OBJECT' THEN json_keys(doc) END AS keys,
    doc ->> '$.event_id' AS event_id, doc ->> '$.event_type' AS event_type,
    doc ->> '$.customer_id' AS customer_id, doc ->> '$.occurred_at' AS occurred_text,
    doc ->> '$.amount' AS amount_text, doc ->> '$.currency' AS currency,
    doc ->> '$.document_text' AS document_text, doc ->> '$.schema_version' AS schema_version
  FROM parsed),
failures AS (
  SELECT "offset", 0 AS place, 'value' AS field, 'json_object' AS rule,
    'Message should be one JSON object' AS message FROM fields WHERE NOT is_object
  UNION ALL SELECT "offset", 1, 'event_id', 'uuid', 'Input should be a valid UUID' FROM fields
    WHERE is_object AND NOT regexp_full_match(lower(event_id),
      '[0-9a-f]{8}-[0-9a-f]{4}-[0-9a-f]{4}-[0-9a-f]{4}-[0-9a-f]{12}')
  UNION ALL SELECT "offset", 2, 'event_type', 'string', 'Input should be a valid string' FROM fields
    WHERE is_object AND json_type(doc, '$.event_type') <> 'VARCHAR'
  UNION ALL SELECT "offset", 2, 'event_type', 'length', 'String should have at least 3 characters'
    FROM fields WHERE is_object AND json_type(doc, '$.event_type') = 'VARCHAR'
      AND length(trim(event_type)) < 3
  UNION ALL SELECT "offset", 3, 'customer_id', 'length', 'String should have at least 1 characters'
    FROM fields WHERE is_object AND length(trim(customer_id)) < 1
  UNION ALL SELECT "offset", 4, 'occurred_at', 'tz_aware',
    'occurred_at must include a timezone offset' FROM fields
    WHERE is_object AND NOT regexp_matches(occurred_text, '(Z|[+-][0-9]{2}:[0-9]{2})$')
  UNION ALL SELECT "offset", 5, 'amount', 'non_negative',
    'Input should be greater than or equal to 0' FROM fields
    WHERE is_object AND CAST(amount_text AS DECIMAL(38,6)) < 0
  UNION ALL SELECT "offset", 5, 'amount', 'decimal',
    'Decimal input should have no more than 2 decimal places' FROM fields
    WHERE is_object AND CAST(amount_text AS DECIMAL(38,6)) >= 0
      AND CAST(amount_text AS DECIMAL(38,6)) <> round(CAST(amount_text AS DECIMAL(38,6)), 2)
  UNION ALL SELECT "offset", 6, 'currency', 'pattern', 'String should match pattern ''^[A-Z]{3}$'''
    FROM fields WHERE is_object AND NOT regexp_full_match(trim(currency), '[A-Z]{3}')
  UNION ALL SELECT "offset", 7, 'schema_version', 'pattern',
    'String should match pattern ''^1\.0$''' FROM fields
    WHERE is_object AND trim(schema_version) <> '1.0'
  UNION ALL SELECT "offset", 8, 'document_text', 'length',
    'String should have at most 20000 characters' FROM fields
    WHERE is_object AND length(regexp_replace(document_text,
      '^[\t-\r \x85\p{Z}]+|[\t-\r \x85\p{Z}]+$', '', 'g')) > 20000
  UNION ALL SELECT "offset", 5, 'amount', 'missing', 'Field required' FROM fields
    WHERE is_object AND NOT list_contains(keys, 'amount')
  UNION ALL SELECT "offset", 10, 'unexpected_field', 'extra_forbidden',
    'Extra inputs are not permitted' FROM fields
    WHERE is_object AND list_contains(keys, 'unexpected_field')),
reasons AS (
  SELECT "offset", count(*) AS broken,
    string_agg(field || ':' || rule, ',' ORDER BY place) AS rules,
    string_agg(message, '; ' ORDER BY place) AS messages,
    array_to_string(list_sort(list_distinct(list(field))), ', ') AS invalid_fields,
    '[' || string_agg('{"field":"' || field || '","rule":"' || rule || '","message":"' ||
      replace(message, chr(92), chr(92) || chr(92)) || '"}', ',' ORDER BY place) || ']' AS reason
  FROM failures GROUP BY "offset"),
judged AS (
  SELECT f.*, coalesce(r.broken, 0) AS broken, r.rules, r.messages, r.invalid_fields, r.reason,
    regexp_extract(occurred_text, '([+-])([0-9]{2}):([0-9]{2})$', 2) AS offset_hours
  FROM fields f LEFT JOIN reasons r ON r."offset" = f."offset"),
accepted AS (
  SELECT lower(event_id) AS event_id, trim(event_type) AS event_type,
    trim(customer_id) AS customer_id,
    CAST(replace(left(occurred_text, 16), ' ', 'T') || CASE WHEN length(occurred_text) > 17
        THEN regexp_extract(occurred_text, '^.{16}(:[0-9]{2}([.][0-9]+)?)', 1) ELSE ':00' END
      AS TIMESTAMP)
      - CASE WHEN offset_hours = '' THEN 0 ELSE CAST(offset_hours AS INT) END * INTERVAL '1' HOUR
      AS occurred_at,
    CAST(amount_text AS DECIMAL(16,2)) AS amount, trim(currency) AS currency,
    regexp_replace(document_text, '^[\t-\r \x85\p{Z}]+|[\t-\r \x85\p{Z}]+$', '', 'g')
      AS document_text,
    trim(schema_version) AS schema_version, 'validated.events' AS kafka_topic,
    "partition" AS kafka_partition, "offset" AS kafka_offset, "timestamp" AS kafka_timestamp,
    "timestamp" AS ingested_at, value, topic
  FROM judged WHERE broken = 0)"""

SINK = JUDGED + r""", sink AS (
  SELECT event_id AS key, '{"event_id":"' || event_id || '","event_type":"' || event_type
    || '","customer_id":"' || customer_id || '","occurred_at":"'
    || strftime(occurred_at, '%Y-%m-%dT%H:%M:%S')
    || CASE WHEN strftime(occurred_at, '%f') = '000000' THEN ''
         ELSE '.' || strftime(occurred_at, '%f') END
    || 'Z","amount":"' || CAST(amount AS VARCHAR) || '","currency":"' || currency
    || '","document_text":' || coalesce(CAST(to_json(document_text) AS VARCHAR), 'null')
    || ',"schema_version":"' || schema_version || '"}' AS value,
    kafka_topic AS topic, kafka_partition AS "partition", kafka_offset AS "offset",
    kafka_timestamp AS "timestamp" FROM accepted)"""

REFUSED = JUDGED + """, refused AS (
  SELECT topic || ':' || "partition" || ':' || "offset" AS key, 'quarantine.events' AS topic,
    "partition", "offset", "timestamp",
    '{"payload":' || CAST(to_json(value) AS VARCHAR) || ',"rejection_reason":'
      || CAST(to_json(reason) AS VARCHAR) || ',"source":{"topic":"' || topic
      || '","partition":' || "partition" || ',"offset":' || "offset"
      || ',"received_at":"' || strftime("timestamp", '%Y-%m-%dT%H:%M:%SZ')
      || '"},"rejected_at":"' || strftime("timestamp" + INTERVAL '1' SECOND, '%Y-%m-%dT%H:%M:%SZ')
      || '"}' AS value
  FROM judged WHERE broken > 0)"""

ROUTED = SINK + REFUSED.removeprefix(JUDGED) + """, routed AS (
  SELECT 'validated.events' AS topic, key, value, "offset" FROM sink
  UNION ALL SELECT topic, key, value, "offset" FROM refused)"""

CHUNKS = cte("text_events") + r""", normal AS (
  SELECT event_id AS document_id, 'delta://silver/customer_events/' || event_id AS source_uri,
    event_type || ' event for customer ' || customer_id AS title,
    trim(regexp_replace(document_text, '[\s\x0b\x1c-\x1f\x85\p{Z}]+', ' ', 'g')) AS body
  FROM text_events WHERE document_text IS NOT NULL),
steps AS (
  WITH RECURSIVE walk AS (
    SELECT document_id, body, 0 AS chunk_number, 0 AS first, CASE WHEN length(body) <= 800
        THEN length(body) ELSE coalesce(nullif(800 - strpos(reverse(left(body, 800)), ' '), 800),
          800) END AS last
    FROM normal WHERE body <> ''
    UNION ALL
    SELECT document_id, body, chunk_number + 1, start,
      CASE WHEN length(body) - start <= 800 THEN length(body)
           WHEN space > 0 AND 800 - space > 120 THEN start + 800 - space
           ELSE start + 800 END
    FROM (SELECT document_id, body, chunk_number, last - 120 AS start,
            strpos(reverse(substr(body, last - 120 + 1, 800)), ' ') AS space
          FROM walk WHERE last < length(body)))
  SELECT document_id, chunk_number, substr(body, first + 1, last - first) AS text FROM walk),
chunks AS (
  SELECT sha256(s.document_id || ':' || CAST(s.chunk_number AS VARCHAR) || ':' || s.text)
      AS chunk_id, s.document_id, n.source_uri, n.title, s.chunk_number, s.text
  FROM steps s JOIN normal n ON n.document_id = s.document_id)"""

TERMS = r"list_filter(regexp_split_to_array(lower({text}), '[^\p{{L}}\p{{N}}]+'), lambda t: t <> '')"


def vectors(name: str, source: str, key: str, text: str) -> str:
    """Hashed term vectors of a text column as one list of 64 numbers per key."""
    return f""", {name}_buckets AS (
  SELECT {key}, CAST(('0x' || left(md5(term), 8)) AS BIGINT) % 64 AS bucket, count(*) AS n
  FROM (SELECT {key}, unnest({TERMS.format(text=text)}) AS term FROM {source})
  GROUP BY ALL),
{name}_dims AS (SELECT CAST(range AS BIGINT) AS bucket FROM range(64)),
{name}_norm AS (SELECT {key}, sqrt(sum(n * n)) AS norm FROM {name}_buckets GROUP BY {key}),
{name} AS (
  SELECT k.{key}, list(CAST(CAST(coalesce(b.n, 0) / k.norm AS FLOAT) AS DOUBLE) ORDER BY d.bucket)
    AS embedding
  FROM {name}_norm k CROSS JOIN {name}_dims d
  LEFT JOIN {name}_buckets b ON b.{key} = k.{key} AND b.bucket = d.bucket GROUP BY k.{key})"""


POSTINGS = CHUNKS + f""", postings AS (
  SELECT chunk_id, field, term, count(*) AS tf FROM (
    SELECT chunk_id, 'title' AS field, unnest({TERMS.format(text='title')}) AS term FROM chunks
    UNION ALL
    SELECT chunk_id, 'text' AS field, unnest({TERMS.format(text='text')}) AS term FROM chunks)
  GROUP BY chunk_id, field, term),
lengths AS (SELECT chunk_id, field, sum(tf) AS length FROM postings GROUP BY chunk_id, field),
field_stats AS (SELECT field, count(*) AS chunks, avg(length) AS average_length FROM lengths
  GROUP BY field),
frequencies AS (SELECT field, term, count(*) AS document_frequency FROM postings
  GROUP BY field, term)"""


LISTED = """coalesce(string_agg(term || ':' || tf, ',' ORDER BY term || ':' || tf)
      FILTER (field = '{0}'), '')"""
INDEXED = POSTINGS + vectors("v", "chunks", "chunk_id", "text") + f""", listed AS (
  SELECT chunk_id, md5({LISTED.format("title")}) AS title_terms,
    md5({LISTED.format("text")}) AS text_terms,
    coalesce(sum(tf) FILTER (field = 'title'), 0)::INT AS title_length,
    coalesce(sum(tf) FILTER (field = 'text'), 0)::INT AS text_length
  FROM postings GROUP BY chunk_id),
summed AS (
  SELECT chunk_id, round(list_sum(list_transform(embedding, lambda x, n: x * n)), 4) AS vector FROM v),
indexed AS (
  SELECT c.*, coalesce(s.vector, 0.0) AS vector, l.* EXCLUDE (chunk_id) FROM chunks c
  JOIN listed l ON l.chunk_id = c.chunk_id LEFT JOIN summed s ON s.chunk_id = c.chunk_id)"""


def ranked(name: str, source: str, score: str, k: int) -> str:
    return f""", {name} AS (
  SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY query_id ORDER BY {score} DESC, chunk_id)
    AS rank FROM {source}) WHERE rank <= {k})"""


LEXICAL = POSTINGS + ", " + cte("questions") + f""", asked AS (
  SELECT query_id, term, count(*) AS times FROM (
    SELECT query_id, unnest({TERMS.format(text='query')}) AS term FROM questions)
  GROUP BY query_id, term),
by_field AS (
  SELECT a.query_id, p.chunk_id, p.field, sum(a.times
    * ln(1 + (s.chunks - f.document_frequency + 0.5) / (f.document_frequency + 0.5))
    * p.tf / (p.tf + 1.2 * (0.25 + 0.75 * l.length / s.average_length))) AS score
  FROM asked a JOIN postings p ON p.term = a.term
  JOIN lengths l ON l.chunk_id = p.chunk_id AND l.field = p.field
  JOIN field_stats s ON s.field = p.field
  JOIN frequencies f ON f.field = p.field AND f.term = p.term
  GROUP BY a.query_id, p.chunk_id, p.field),
lexical_scores AS (
  SELECT query_id, chunk_id, round(max(CASE field WHEN 'title' THEN 2 * score ELSE score END), 12)
    AS lexical_score FROM by_field GROUP BY query_id, chunk_id)""" + ranked(
    "lexical", "lexical_scores", "lexical_score", 20)

DENSE_PARTS = (
    vectors("chunk_vectors", "chunks", "chunk_id", "text")
    + vectors("question_vectors", "questions", "query_id", "query")
    + """, dense_scores AS (
  SELECT q.query_id, c.chunk_id, round(list_dot_product(q.embedding, c.embedding), 12) AS dense_score
  FROM question_vectors q CROSS JOIN chunk_vectors c)"""
    + ranked("dense", "dense_scores", "dense_score", 20))

DENSE = CHUNKS + ", " + cte("questions") + DENSE_PARTS

FUSED = LEXICAL + DENSE_PARTS + """, fused_scores AS (
  SELECT query_id, chunk_id, round(sum(1.0 / (60 + rank)), 12) AS fused_score,
    coalesce(max(dense_score), 0.0) AS dense_score,
    coalesce(max(lexical_score), 0.0) AS lexical_score
  FROM (SELECT query_id, chunk_id, rank, dense_score, NULL AS lexical_score FROM dense
        UNION ALL SELECT query_id, chunk_id, rank, NULL, lexical_score FROM lexical)
  GROUP BY query_id, chunk_id)""" + ranked("fused", "fused_scores", "fused_score", 20)

RERANKED = FUSED + f""", pairs AS (
  SELECT f.* EXCLUDE (rank), c.* EXCLUDE (chunk_id), q.query,
    list_distinct({TERMS.format(text='q.query')}) AS wanted,
    {TERMS.format(text='c.text')} AS present
  FROM fused f JOIN chunks c ON c.chunk_id = f.chunk_id JOIN questions q
    ON q.query_id = f.query_id),
rated AS (
  SELECT * EXCLUDE (wanted, present), round(len(list_intersect(wanted, present)) / len(wanted), 12)
    AS rerank_score FROM pairs),
best AS (
  SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY query_id
    ORDER BY rerank_score DESC, fused_score DESC, chunk_id) AS rank FROM rated) WHERE rank <= 5)"""


def gate(layer: str, table: str, rules: list[tuple[str, str, str]]) -> str:
    """One line per rule ``(kind, columns, failing condition)`` of a table."""
    lines = []
    for kind, columns, broken in rules:
        if kind == "unique":
            keys = columns.split(",")
            some = " OR ".join(f"{k} IS NOT NULL" for k in keys)
            lines.append(
                f"SELECT '{layer}' AS layer, '{kind}' AS rule, '{columns}' AS columns, "
                f"coalesce(sum(n), 0) AS checked, coalesce(sum(n) FILTER (n > 1), 0) AS failed "
                f"FROM (SELECT count(*) AS n FROM {table} WHERE {some} GROUP BY {columns})")
        else:
            checked = "count(*)" if kind == "not_null" else f"count({columns})"
            lines.append(
                f"SELECT '{layer}' AS layer, '{kind}' AS rule, '{columns}' AS columns, "
                f"{checked} AS checked, count(*) FILTER ({broken}) AS failed FROM {table}")
    body = " UNION ALL ".join(lines)
    return (f"SELECT layer, rule, columns, CAST(checked AS BIGINT) AS checked, "
            f"CAST(failed AS BIGINT) AS failed, failed = 0 AS passed FROM ({body})")


SILVER_RULES = [("not_null", "event_id", "event_id IS NULL"), ("unique", "event_id", ""),
                ("not_null", "customer_id", "customer_id IS NULL"),
                ("between", "amount", "amount < 0")]
GOLD_RULES = [("not_null", "customer_id", "customer_id IS NULL"),
              ("not_null", "currency", "currency IS NULL"),
              ("unique", "customer_id,event_day,currency", ""),
              ("between", "event_count", "event_count < 1"),
              ("between", "total_amount", "total_amount < 0")]
CURRENT_RULES = [("not_null", "event_id", "event_id IS NULL"),
                 ("unique", "customer_id,event_type", "")]
BRONZE_RULES = [("not_null", "event_id", "event_id IS NULL"),
                ("not_null", "kafka_offset", "kafka_offset IS NULL")]

MERGED = HISTORY + """, target AS (
  SELECT * FROM deliveries WHERE batch <> 'duplicates' AND kafka_partition <> 2),
changes AS (
  SELECT * REPLACE (
    CASE WHEN kafka_partition = 1 THEN CAST(0 AS DECIMAL(16,2)) ELSE amount END AS amount,
    CASE WHEN kafka_partition = 1 THEN ingested_at - INTERVAL '1' HOUR ELSE ingested_at END
      AS ingested_at) FROM deliveries WHERE batch <> 'late' OR kafka_partition = 2),
source AS (
  SELECT * EXCLUDE (place) FROM (SELECT *, row_number() OVER (PARTITION BY event_id
    ORDER BY ingested_at DESC, kafka_timestamp DESC, kafka_partition DESC, kafka_offset DESC)
    AS place FROM changes) WHERE place = 1),
merged AS (
  SELECT s.* FROM source s JOIN target t ON t.event_id = s.event_id
    WHERE s.ingested_at >= t.ingested_at
  UNION ALL SELECT t.* FROM target t LEFT JOIN source s ON t.event_id = s.event_id
    WHERE s.event_id IS NULL OR s.ingested_at < t.ingested_at
  UNION ALL SELECT s.* FROM source s WHERE s.event_id NOT IN (SELECT event_id FROM target))"""

CHUNK_COLUMNS = "chunk_id, document_id, source_uri, title, chunk_number, text"

SQL: dict[str, str] = {
    "gold_daily_metrics": f"WITH {GOLD} SELECT customer_id, event_day, currency, event_count, "
        "CAST(total AS DOUBLE) AS total_amount, round(mean, 6) AS average_amount FROM gold",
    "silver_history": f"WITH {HISTORY} SELECT {DELIVERY_COLUMNS} FROM history",
    "silver_current": f"WITH {CURRENT} SELECT {DELIVERY_COLUMNS} FROM state",
    "bronze_summary": f"WITH {cte('deliveries')} SELECT count(*) AS bronze_deliveries, "
        "count(DISTINCT event_id) AS unique_event_ids, count(*) - count(DISTINCT event_id) "
        "AS replayed_deliveries FROM deliveries",
    "batch_record_counts": f"WITH {cte('deliveries')} SELECT batch, count(*) AS records "
        "FROM deliveries GROUP BY batch",
    "events_by_type": f"WITH {HISTORY} SELECT event_type, count(*) AS events FROM history "
        "GROUP BY event_type",
    "daily_total_by_currency": f"WITH {GOLD} SELECT currency, event_day, "
        "CAST(sum(total) AS DOUBLE) AS total_amount FROM gold GROUP BY currency, event_day",
    "late_in_history": f"WITH {HISTORY} SELECT event_id, customer_id, event_type, occurred_at, "
        "ingested_at FROM history WHERE event_id IN (SELECT event_id FROM deliveries "
        "WHERE batch = 'late')",
    "replayed_ids": f"WITH {cte('deliveries')} SELECT event_id FROM deliveries "
        "WHERE batch = 'duplicates' INTERSECT SELECT event_id FROM deliveries "
        "WHERE batch = 'valid'",
    "new_ids": f"WITH {cte('deliveries')} SELECT event_id FROM deliveries "
        "WHERE batch = 'duplicates' EXCEPT SELECT event_id FROM deliveries WHERE batch = 'valid'",
    "merge_upsert": f"WITH {MERGED} SELECT {DELIVERY_COLUMNS} FROM merged",
    "merge_upsert_small_source": f"WITH {MERGED} SELECT {DELIVERY_COLUMNS} FROM merged",
    "merge_upsert_buckets": f"WITH {MERGED} SELECT {DELIVERY_COLUMNS} FROM merged",

    "validate_events": f"WITH {JUDGED} SELECT \"offset\", broken = 0 AS valid, "
        "coalesce(rules, '') AS rules FROM judged",
    "split_valid_quarantine": f"WITH {JUDGED} SELECT CASE WHEN broken = 0 THEN 'valid' "
        "ELSE 'quarantine' END AS route, \"offset\", topic, \"partition\" FROM judged",
    "quarantine_records": f"WITH {JUDGED} SELECT value AS payload, reason AS rejection_reason, "
        "topic, \"partition\", \"offset\", \"timestamp\" AS received_at, "
        "\"timestamp\" + INTERVAL '1' SECOND AS rejected_at FROM judged WHERE broken > 0",
    "quarantine_overview": f"WITH {JUDGED} SELECT topic, \"partition\", \"offset\", "
        "CASE WHEN is_object THEN coalesce(event_id, 'missing') ELSE 'missing' END "
        "AS event_reference, invalid_fields, messages AS reasons FROM judged WHERE broken > 0",
    "quarantine_field_summary": f"WITH {JUDGED} SELECT field, rule, count(*) AS failures "
        "FROM failures GROUP BY field, rule",
    "validated_sink": f"WITH {SINK} SELECT * FROM sink",
    "quarantine_sink": f"WITH {REFUSED} SELECT * FROM refused",
    "bronze_ingest": f"WITH {JUDGED} SELECT {DELIVERY_COLUMNS} FROM accepted",
    "bronze_stream": f"WITH {JUDGED} SELECT {DELIVERY_COLUMNS} FROM accepted",
    "route_messages": f"WITH {ROUTED} SELECT * FROM routed",
    "validate_stream": f"WITH {ROUTED} SELECT * FROM routed",
    "silver_stream": f"WITH {HISTORY} SELECT {DELIVERY_COLUMNS} FROM history",
    "stage_reconciliation": f"""WITH {JUDGED}, kept AS (SELECT event_id, customer_id, event_type
        FROM accepted GROUP BY ALL)
      SELECT 'raw' AS stage, count(*) AS rows FROM judged
      UNION ALL SELECT 'validated', count(*) FROM judged WHERE broken = 0
      UNION ALL SELECT 'quarantine', count(*) FROM judged WHERE broken > 0
      UNION ALL SELECT 'bronze', count(*) FROM accepted
      UNION ALL SELECT 'history', count(DISTINCT event_id) FROM accepted
      UNION ALL SELECT 'current', count(*) FROM (SELECT DISTINCT customer_id, event_type FROM kept)
      UNION ALL SELECT 'gold_event_count', count(DISTINCT event_id) FROM accepted""",

    "gate_bronze": f"WITH {cte('deliveries')} " + gate("bronze", "deliveries", BRONZE_RULES),
    "gate_silver": f"WITH {HISTORY} " + gate("silver", "history", SILVER_RULES),
    "gate_silver_current": f"WITH {CURRENT} " + gate("silver_current", "state", CURRENT_RULES),
    "gate_gold": f"WITH {GOLD}, shown AS (SELECT *, total AS total_amount FROM gold) "
        + gate("gold", "shown", GOLD_RULES),
    "gate_silver_faulty": f"WITH {cte('deliveries', 'faulty')} "
        + gate("silver", "faulty", SILVER_RULES),
    "gate_violations": f"""WITH {cte('deliveries', 'faulty')}
      SELECT 'silver' AS layer, 'not_null' AS rule, 'event_id' AS columns, event_id, customer_id,
        CAST(amount AS DOUBLE) AS amount, kafka_offset FROM faulty WHERE event_id IS NULL
      UNION ALL SELECT 'silver', 'not_null', 'customer_id', event_id, customer_id,
        CAST(amount AS DOUBLE), kafka_offset FROM faulty WHERE customer_id IS NULL
      UNION ALL SELECT 'silver', 'between', 'amount', event_id, customer_id,
        CAST(amount AS DOUBLE), kafka_offset FROM faulty WHERE amount < 0
      UNION ALL SELECT 'silver', 'unique', 'event_id', event_id, customer_id,
        CAST(amount AS DOUBLE), kafka_offset FROM faulty WHERE event_id IN
          (SELECT event_id FROM faulty GROUP BY event_id HAVING count(*) > 1)""",
    "expect_not_null": f"WITH {cte('deliveries', 'faulty')} "
        + gate("table", "faulty", [("not_null", "customer_id", "customer_id IS NULL")]),
    "expect_unique": f"WITH {cte('deliveries', 'faulty')} "
        + gate("table", "faulty", [("unique", "event_id,customer_id", "")]),
    "expect_between": f"WITH {cte('deliveries', 'faulty')} "
        + gate("table", "faulty", [("between", "amount", "amount < 0 OR amount > 100")]),

    "documents_with_text": f"WITH {HISTORY} SELECT event_id, customer_id, event_type, "
        "md5(document_text) AS document_md5 FROM history WHERE document_text IS NOT NULL AND "
        r"trim(regexp_replace(document_text, '[\s\x0b\x1c-\x1f\x85\p{Z}]+', ' ', 'g')) <> ''",
    "document_metadata": f"WITH {HISTORY} SELECT event_id AS document_id, "
        "'delta://silver/customer_events/' || event_id AS source_uri, "
        "event_type || ' event for customer ' || customer_id AS title, "
        "md5(document_text) AS text_md5 FROM history WHERE document_text IS NOT NULL AND "
        r"trim(regexp_replace(document_text, '[\s\x0b\x1c-\x1f\x85\p{Z}]+', ' ', 'g')) <> ''",
    "normalize_text": f"WITH {CHUNKS} SELECT document_id, body AS text FROM normal "
        "WHERE body <> ''",
    "chunk_documents": f"WITH {CHUNKS} SELECT {CHUNK_COLUMNS} FROM chunks",
    "chunk_ids": f"WITH {CHUNKS} SELECT document_id, chunk_number, chunk_id FROM chunks",
    "chunk_stats": f"WITH {CHUNKS} SELECT document_id, count(*) AS chunks, "
        "CAST(sum(length(text)) AS BIGINT) AS characters FROM chunks GROUP BY document_id",
    "chunk_total": f"WITH {CHUNKS} SELECT count(*) AS indexed_chunks, "
        "count(DISTINCT document_id) AS documents FROM chunks",
    "vector_table_sink": f"WITH {INDEXED} SELECT * FROM indexed",
    "refresh_index": f"WITH {INDEXED} SELECT * FROM indexed",
    "embed_text": f"WITH {CHUNKS}{vectors('v', 'chunks', 'chunk_id', 'text')} SELECT chunk_id, "
        "CAST(i AS INT) AS dimension, round(embedding[i + 1], 6) AS weight "
        "FROM v CROSS JOIN (SELECT range AS i FROM range(64))",
    "normalize_vectors": """SELECT vec_id, CAST(i AS INT) AS dimension,
        round(CAST(embedding[i + 1] AS DOUBLE) / sqrt(list_dot_product(
          CAST(embedding AS DOUBLE[]), CAST(embedding AS DOUBLE[]))), 6) AS weight
      FROM embeddings CROSS JOIN (SELECT range AS i FROM range(64))""",
    "dense_knn": """WITH unit AS (SELECT vec_id, list_transform(CAST(embedding AS DOUBLE[]),
          lambda x: x / sqrt(list_dot_product(CAST(embedding AS DOUBLE[]),
            CAST(embedding AS DOUBLE[])))) AS v FROM embeddings),
      scored AS (SELECT q.vec_id AS query_id, c.vec_id AS vec_id,
        round(list_dot_product(q.v, c.v), 12) AS dense_score FROM unit q CROSS JOIN unit c)
      SELECT * REPLACE (round(dense_score, 6) AS dense_score) FROM (SELECT *, row_number() OVER (
        PARTITION BY query_id ORDER BY dense_score DESC, vec_id) AS rank FROM scored)
      WHERE rank <= 20""",
    "topk_dense": f"WITH {DENSE} SELECT query_id, chunk_id, round(dense_score, 6) AS dense_score, rank FROM dense",
    "bm25_index": f"WITH {POSTINGS} SELECT chunk_id, field, term, tf FROM postings",
    "corpus_stats": f"WITH {POSTINGS} SELECT field, chunks, round(average_length, 6) "
        "AS average_length FROM field_stats",
    "document_frequencies": f"WITH {POSTINGS} SELECT field, term, document_frequency "
        "FROM frequencies",
    "bm25_search": f"WITH {LEXICAL} SELECT query_id, chunk_id, round(lexical_score, 6) AS lexical_score FROM lexical",
    "topk_lexical": f"WITH {LEXICAL} SELECT query_id, chunk_id, rank FROM lexical",
    "retrieval_rank": f"WITH {LEXICAL}{DENSE_PARTS} SELECT query_id, 'dense' AS retriever, "
        "chunk_id, rank FROM dense UNION ALL SELECT query_id, 'lexical', chunk_id, rank "
        "FROM lexical",
    "rrf_fuse": f"WITH {FUSED} SELECT query_id, chunk_id, round(fused_score, 6) AS fused_score, round(dense_score, 6) AS dense_score, "
        "round(lexical_score, 6) AS lexical_score FROM fused_scores",
    "hybrid_fuse": f"WITH {FUSED} SELECT query_id, chunk_id, round(fused_score, 6) AS fused_score, round(dense_score, 6) AS dense_score, "
        "round(lexical_score, 6) AS lexical_score, rank FROM fused",
    "rrf_topk": f"WITH {FUSED} SELECT query_id, chunk_id, rank FROM fused",
    "rerank": f"WITH {RERANKED} SELECT query_id, chunk_id, round(rerank_score, 6) AS rerank_score FROM best",
    "rerank_topk": f"WITH {RERANKED} SELECT query_id, chunk_id, rank FROM best",
    "hybrid_retrieve": f"WITH {RERANKED} SELECT query_id, rank, {CHUNK_COLUMNS}, round(dense_score, 6) AS dense_score, "
        "round(lexical_score, 6) AS lexical_score, round(fused_score, 6) AS fused_score, round(rerank_score, 6) AS rerank_score FROM best",
    "grounded_context": f"WITH {RERANKED} SELECT q.query_id, coalesce(string_agg('[' || b.rank "
        "|| '] ' || b.text, chr(10) || chr(10) ORDER BY b.rank), "
        "'Insufficient context to answer the question.') AS context FROM questions q "
        "LEFT JOIN best b ON b.query_id = q.query_id GROUP BY q.query_id",
    "citations": f"WITH {RERANKED} SELECT query_id, rank AS place, document_id, chunk_id, "
        "source_uri, title FROM best",
}
SQL["dense_knn_grid"] = SQL["dense_knn"]
SQL["bm25_search_grid"] = SQL["bm25_search"]
SQL["dense_knn_cells"] = SQL["dense_knn"]
SQL["bm25_search_blocks"] = SQL["bm25_search"]

# What is kept up to date by changes equals what the whole history gives.
SQL["gold_incremental"] = SQL["gold_daily_metrics"]
SQL["silver_current_incremental"] = SQL["silver_current"]
