"""Support-message views derived from the general test tables.

The texts run unchanged in Spark SQL and in ANSI engines; ``{name}`` stands for a table.
"""

import re

from pyspark.sql import DataFrame, SparkSession

from deskflow.sources.tables import spread

# The brand account of the derived posts.
BRAND = "Support"

# Customer posts of all intents, with no-match rows, mixed-case keywords, short texts, handles, URLs,
# entities, non-ASCII, duplicates and unanswered posts; replies and second replies of the brand.
POSTS = """
SELECT CAST(event_id AS VARCHAR(20)) AS tweet_id, CONCAT('u', CAST(user_id AS VARCHAR(20))) AS author_id,
 CASE WHEN event_id % 2 = 0 THEN 'True' ELSE 'true' END AS inbound, ts AS created_at,
 CONCAT(CASE WHEN event_id % 5 = 0 THEN '@support ' ELSE '' END, CASE event_id % 12
   WHEN 0 THEN 'My phone was hacked and someone changed it' WHEN 1 THEN 'I cannot log in with my apple id today'
   WHEN 2 THEN 'Please refund me, I was charged twice' WHEN 3 THEN 'The charger is not charging my phone'
   WHEN 4 THEN 'battery drain is very bad since Monday' WHEN 5 THEN 'icloud photos sync is stuck at one percent'
   WHEN 6 THEN 'the app store will not download app files' WHEN 7 THEN 'How do I pair my new headphones by bluetooth'
   WHEN 8 THEN 'Stuck after the software update to ios 11' WHEN 9 THEN 'my ipad was Stolen at the gym, battery low'
   WHEN 10 THEN 'Hello, a general question about opening hours' WHEN 11 THEN 'hi' END,
  CASE WHEN event_id % 10 = 0 THEN '' ELSE CONCAT(' case ', CAST(event_id AS VARCHAR(20))) END,
  CASE WHEN event_id % 7 = 0 THEN ' https://ex.am/p?a=1' ELSE '' END,
  CASE WHEN event_id % 9 = 0 THEN ' &amp; é' ELSE '' END) AS text,
 CAST(NULL AS VARCHAR(20)) AS response_tweet_id, CAST(NULL AS VARCHAR(20)) AS in_response_to_tweet_id
FROM {events}
UNION ALL
SELECT CONCAT('r', CAST(event_id AS VARCHAR(20))), 'Support', 'False', ts,
 CONCAT('We can help with that. Please check Settings, reply ', CAST(event_id AS VARCHAR(20))),
 CAST(NULL AS VARCHAR(20)), CAST(event_id AS VARCHAR(20))
FROM {events} WHERE event_id % 3 <> 0 OR event_id % 7 < 4
UNION ALL
SELECT CONCAT('s', CAST(event_id AS VARCHAR(20))), 'Support', 'False', ts, 'A second answer to the same post',
 CAST(NULL AS VARCHAR(20)), CAST(event_id AS VARCHAR(20))
FROM {events} WHERE event_id % 50 = 1
"""

# Every text of the test tables under one key.
TEXTS = f"""
SELECT CONCAT('d', CAST(doc_id AS VARCHAR(20))) AS text_id, text FROM {{documents}}
UNION ALL
SELECT CONCAT('c', CAST(conv_id AS VARCHAR(20)), '-', CAST(turn AS VARCHAR(20))), text FROM {{conversations}}
UNION ALL
SELECT CONCAT('p', tweet_id), text FROM ({POSTS}) posts
"""

# True and predicted classes and routings per event; one predicted class never occurs as truth.
JUDGED = """
SELECT event_id, event_type AS truth,
 CASE CAST(FLOOR(value) AS BIGINT) % 6 WHEN 0 THEN 'click' WHEN 1 THEN 'error' WHEN 2 THEN 'purchase'
   WHEN 3 THEN 'signup' WHEN 4 THEN 'view' ELSE 'refund' END AS predicted,
 CASE WHEN event_type IN ('error', 'purchase') THEN 'ESCALATE' ELSE 'AUTO' END AS truth_route,
 CASE WHEN value > 60 OR user_id % 3 = 0 THEN 'ESCALATE' ELSE 'AUTO' END AS route
FROM {events}
"""

# Human scores of documents, from their quality and toxicity labels.
HUMAN = """
SELECT d.doc_id, d.text, 3 + 2 * l.quality AS human_correctness, 5 - 2 * l.toxic AS human_helpfulness,
 4 + l.quality - l.toxic AS human_brand_tone, CAST(3 + d.doc_id % 3 AS INTEGER) AS human_groundedness
FROM {documents} d JOIN {labels} l ON d.doc_id = l.doc_id
"""

# Index rows: a vector with the texts of the post of the same number.
INDEX = """
SELECT v.vec_id AS id, v.embedding, CONCAT('question ', CAST(e.event_id AS VARCHAR(20)), ' of ', e.event_type) AS tweet,
 CONCAT('Please check Settings, reply ', CAST(v.vec_id AS VARCHAR(20))) AS apple_reply,
 CONCAT('class_', CAST(v.label AS VARCHAR(20))) AS intent
FROM {embeddings} v JOIN {events} e ON v.vec_id = e.event_id
"""

# Stored answers of a judge: quoted and unquoted numbers, a missing field, unreadable text.
ANSWERS = """
SELECT event_id, CONCAT('Please see Settings ', event_type) AS generated_reply,
 CASE event_id % 4
   WHEN 0 THEN CONCAT('{"correctness": ', CAST(1 + event_id % 5 AS VARCHAR(20)), ', "helpfulness": "', CAST(1 + user_id % 5 AS VARCHAR(20)), '", "brand_tone": 3, "groundedness": 5, "explanation": "', event_type, '"}')
   WHEN 1 THEN CONCAT('{"correctness": ', CAST(1 + user_id % 5 AS VARCHAR(20)), ', "brand_tone": 4.7, "explanation": "short"}')
   WHEN 2 THEN CONCAT('{"correctness": ', event_type)
   ELSE CONCAT('{"correctness": "good", "helpfulness": ', CAST(1 + event_id % 5 AS VARCHAR(20)), ', "brand_tone": 3, "groundedness": 5}') END AS answer
FROM {events}
"""


def table_names(sql: str) -> list[str]:
    return sorted(set(re.findall(r"\{([a-z]+)\}", sql)))


def plain(sql: str) -> str:
    """The text with its table names, for an engine where the tables are views."""
    for name in table_names(sql):
        sql = sql.replace("{" + name + "}", name)
    return sql


def table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{folder}/{name}.parquet")


def view(spark: SparkSession, folder: str, sql: str, spread_rows: bool = False) -> DataFrame:
    """Run a derived view over the Parquet tables of a folder."""
    for name in table_names(sql):
        rows = table(spark, folder, name)
        name_here = f"deskflow_{name}_spread" if spread_rows else f"deskflow_{name}"
        (spread(rows) if spread_rows else rows).createOrReplaceTempView(name_here)
        sql = sql.replace("{" + name + "}", name_here)
    return spark.sql(sql)
