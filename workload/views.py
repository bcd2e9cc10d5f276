"""Input views over the given tables, stated once in SQL that both engines read.

They only shape inputs: operators get them as DataFrames, the SQL texts as common table
expressions.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from tidelake.session import configure

# One row per delivery. Every tenth event is delivered again a day later with another amount.
DELIVERIES = """
SELECT 'event-' || lpad(CAST(e.event_id AS STRING), 12, '0') AS event_id,
       e.event_type AS event_type,
       'customer-' || CAST(e.user_id AS STRING) AS customer_id,
       CAST(e.ts AS TIMESTAMP) AS occurred_at,
       CAST(CAST(e.value AS DECIMAL(16,2)) + CAST(e.copy AS DECIMAL(16,2)) AS DECIMAL(16,2))
           AS amount,
       CASE e.event_id % 3 WHEN 0 THEN 'SAR' WHEN 1 THEN 'USD' ELSE 'EUR' END AS currency,
       d.text AS document_text,
       '1.0' AS schema_version,
       'validated.events' AS kafka_topic,
       CAST(e.event_id % 3 AS INT) AS kafka_partition,
       e.event_id + e.copy * 1000000000 AS kafka_offset,
       TIMESTAMP '2024-02-01 00:00:00' + (e.event_id + e.copy * 86400) * INTERVAL '1' SECOND
           AS kafka_timestamp,
       TIMESTAMP '2024-02-01 00:00:00' + (e.event_id + e.copy * 86400) * INTERVAL '1' SECOND
           AS ingested_at,
       CASE WHEN e.copy = 1 THEN 'duplicates' WHEN e.event_id % 7 = 3 THEN 'late' ELSE 'valid' END
           AS batch
FROM (SELECT a.*, c.copy FROM {events} a
      JOIN (SELECT CAST(0 AS BIGINT) AS copy, 1 AS every UNION ALL SELECT 1, 10) c
        ON a.event_id % c.every = 0) e
LEFT JOIN {documents} d ON d.doc_id = e.event_id
"""

# Deliveries with faults in keys and amounts, for the quality rules.
FAULTY = """
SELECT CASE WHEN event_id LIKE '%7' AND amount > 20 THEN NULL ELSE event_id END AS event_id,
       event_type,
       CASE WHEN event_id LIKE '%3' AND amount > 30 THEN NULL ELSE customer_id END AS customer_id,
       CAST(CASE WHEN event_id LIKE '%1' THEN -amount ELSE amount END AS DECIMAL(16,2)) AS amount,
       occurred_at, currency, kafka_offset
FROM {deliveries}
"""

# Raw JSON messages; the remainder of the event number decides which rules they break.
MESSAGES = """
SELECT CASE WHEN n % 20 = 11 THEN substr(body, 1, 40)
            WHEN n % 20 = 12 THEN '[' || body || ']'
            ELSE body END AS value,
       'raw.events' AS topic,
       CAST(n % 3 AS INT) AS partition,
       kafka_offset AS "offset",
       kafka_timestamp AS "timestamp",
       n
FROM (
SELECT n, kafka_offset, kafka_timestamp,
       '{' || chr(34) || 'event_id' || chr(34) || ':' || chr(34)
       || CASE n % 20 WHEN 1 THEN 'not-a-uuid-' || CAST(n AS STRING)
            WHEN 16 THEN 'ABCDEF00-0000-4000-8000-' || lpad(CAST(n AS STRING), 12, '0')
            ELSE '00000000-0000-4000-8000-' || lpad(CAST(n AS STRING), 12, '0') END
       || chr(34) || ',' || chr(34) || 'event_type' || chr(34) || ':'
       || CASE n % 20 WHEN 2 THEN chr(34) || 'x' || chr(34)
            WHEN 17 THEN CAST(n AS STRING)
            ELSE chr(34) || event_type || chr(34) END
       || ',' || chr(34) || 'customer_id' || chr(34) || ':' || chr(34)
       || CASE n % 20 WHEN 3 THEN '   ' ELSE customer_id END
       || chr(34) || ',' || chr(34) || 'occurred_at' || chr(34) || ':' || chr(34) || day_text
       || CASE WHEN n % 20 IN (4, 14) THEN 'T08:15:00'
            WHEN n % 20 = 13 THEN 'T01:15:00+03:00'
            WHEN n % 20 = 18 THEN ' 08:15Z'
            ELSE 'T08:15:00.25Z' END
       || chr(34)
       || CASE WHEN n % 20 = 10 THEN ''
            ELSE ',' || chr(34) || 'amount' || chr(34) || ':'
              || CASE WHEN n % 20 IN (5, 14) THEN chr(34) || '-' || amount_text || chr(34)
                   WHEN n % 20 = 6 THEN chr(34) || amount_text || '9' || chr(34)
                   WHEN n % 20 = 15 THEN amount_text
                   ELSE chr(34) || amount_text || chr(34) END END
       || ',' || chr(34) || 'currency' || chr(34) || ':' || chr(34)
       || CASE WHEN n % 20 IN (7, 14) THEN 'saudi-riyal'
            WHEN n % 20 = 13 THEN ' USD '
            ELSE currency END
       || chr(34)
       || CASE WHEN document_text IS NULL AND n % 20 <> 16 THEN ''
            ELSE ',' || chr(34) || 'document_text' || chr(34) || ':'
              || coalesce(chr(34) || replace(replace(replace(document_text,
                   chr(92), chr(92) || chr(92)), chr(34), chr(92) || chr(34)),
                   chr(10), chr(92) || 'n') || chr(34), 'null') END
       || ',' || chr(34) || 'schema_version' || chr(34) || ':' || chr(34)
       || CASE n % 20 WHEN 8 THEN '2.0' ELSE '1.0' END || chr(34)
       || CASE n % 20 WHEN 9 THEN ',' || chr(34) || 'unexpected_field' || chr(34) || ':'
            || chr(34) || 'must be rejected' || chr(34)
            WHEN 19 THEN ',' || chr(34) || 'schema_version' || chr(34) || ':' || chr(34) || '1.0'
            || chr(34) ELSE '' END
       || '}' AS body
FROM (SELECT kafka_offset % 1000000000 AS n, kafka_offset, kafka_timestamp, event_type,
             customer_id, currency, document_text,
             CAST(CAST(occurred_at AS DATE) AS STRING) AS day_text,
             CAST(CAST(amount + 1 AS DECIMAL(16,2)) AS STRING) AS amount_text
      FROM {deliveries}) a) b
"""

# Events with text, the retrieval collection.
TEXT_EVENTS = """
SELECT 'event-' || lpad(CAST(d.doc_id AS STRING), 12, '0') AS event_id,
       'customer-' || CAST(e.user_id AS STRING) AS customer_id,
       e.event_type AS event_type,
       d.text AS document_text
FROM {documents} d JOIN {events} e ON e.event_id = d.doc_id
"""

QUESTIONS = """
SELECT 'q' || lpad(CAST(item_id AS STRING), 6, '0') AS query_id,
       CASE item_id % 4 WHEN 0 THEN 'purchase event ' || text
            WHEN 1 THEN text || ' signup'
            ELSE text END AS query
FROM {benchmark}
"""

TABLES = ("events", "documents", "benchmark", "embeddings")


def cte(*names: str) -> str:
    """A ``WITH`` prefix that defines views over the given tables by their own names."""
    parts = []
    for name in names:
        text = VIEWS[name]
        for inner in (*TABLES, "deliveries"):
            text = text.replace("{" + inner + "}", inner)
        parts.append(f"{name} AS ({text})")
    return ", ".join(parts)


VIEWS = {
    "deliveries": DELIVERIES,
    "faulty": FAULTY,
    "messages": MESSAGES,
    "text_events": TEXT_EVENTS,
    "questions": QUESTIONS,
}


class Inputs:
    """The views as DataFrames over one directory of tables."""

    def __init__(self, spark: SparkSession, sf_dir: str) -> None:
        self.spark = configure(spark)
        self.sf_dir = sf_dir

    def table(self, name: str) -> DataFrame:
        return self.spark.read.parquet(f"{self.sf_dir}/{name}.parquet")

    def _sql(self, text: str, **frames: DataFrame) -> DataFrame:
        for name in frames:
            text = text.replace("{" + name + "}", f"@{name}@")
        text = text.replace("{", "{{").replace("}", "}}").replace('"', "`")
        for name in frames:
            text = text.replace(f"@{name}@", "{" + name + "}")
        return self.spark.sql(text, **frames)

    def deliveries(self) -> DataFrame:
        return self._sql(DELIVERIES, events=self.table("events"),
                         documents=self.table("documents"))

    def faulty(self) -> DataFrame:
        return self._sql(FAULTY, deliveries=self.deliveries())

    def messages(self) -> DataFrame:
        return self._sql(MESSAGES, deliveries=self.deliveries())

    def text_events(self) -> DataFrame:
        return self._sql(TEXT_EVENTS, events=self.table("events"),
                         documents=self.table("documents"))

    def questions(self) -> DataFrame:
        return self._sql(QUESTIONS, benchmark=self.table("benchmark"))
