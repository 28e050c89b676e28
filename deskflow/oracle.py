"""The same questions in ANSI SQL, for a check by another engine on the same Parquet tables."""

import re

from deskflow import fixed
from deskflow.sources import derived

_SPACE = r"\x09-\x0D\x1C-\x20\x{85}\x{A0}\x{1680}\x{2000}-\x{200A}\x{2028}\x{2029}\x{202F}\x{205F}\x{3000}"
_SPACES = "".join(
    chr(c) for lo, hi in ((0x09, 0x0D), (0x1C, 0x20), (0x85, 0x85), (0xA0, 0xA0), (0x1680, 0x1680), (0x2000, 0x200A),
                          (0x2028, 0x2029), (0x202F, 0x202F), (0x205F, 0x205F), (0x3000, 0x3000))
    for c in range(lo, hi + 1)
)


def _quote(s: str) -> str:
    return "'" + s.replace("'", "''") + "'"


def _in(values) -> str:
    return "(" + ", ".join(_quote(v) for v in values) + ")"


def _strip(c: str) -> str:
    return f"coalesce(trim({c}, {_quote(_SPACES)}), '')"


def _clean(c: str) -> str:
    c = f"regexp_replace(coalesce({c}, ''), 'https?://[^{_SPACE}]+|www\\.[^{_SPACE}]+', '', 'g')"
    c = rf"regexp_replace({c}, '@[\p{{L}}\p{{N}}_]+', '', 'g')"
    for a, b in (("&amp;", "&"), ("&lt;", "<"), ("&gt;", ">"), ("&quot;", '"')):
        c = f"replace({c}, '{a}', '{b}')"
    c = rf"regexp_replace({c}, '[^\x20-\x7E]', ' ', 'g')"
    return f"trim(regexp_replace({c}, ' +', ' ', 'g'))"


def _intent(c: str) -> str:
    whens = " ".join(
        rf"WHEN regexp_matches(lower({c}), {_quote(rf'\b({p})\b')}) THEN {_quote(n)}" for n, p in fixed.INTENT_RULES)
    return f"CASE {whens} END"


def _keyword(c: str) -> str:
    alternatives = "|".join(re.escape(k) for k in fixed.RISKY_KEYWORDS)
    return rf"nullif(regexp_extract({c}, '(?i)\b({alternatives})\b', 0), '')"


def _shown(c: str) -> str:
    return f"printf('%.2f', {c})"


def _decision(text: str, intent: str, conf: str) -> str:
    return (
        f"CASE WHEN coalesce({intent}, '') IN {_in(fixed.RISKY_INTENTS)} THEN 'ESCALATE' "
        f"WHEN {_keyword(text)} IS NOT NULL THEN 'ESCALATE' WHEN {conf} < 0.6 THEN 'ESCALATE' ELSE 'AUTO' END"
    )


def _reason(text: str, intent: str, conf: str) -> str:
    name = f"replace(coalesce({intent}, ''), '_', ' ')"
    return (
        f"CASE WHEN coalesce({intent}, '') IN {_in(fixed.RISKY_INTENTS)} "
        f"THEN concat('High-risk intent ''', {intent}, ''' requires specialist intervention') "
        f"WHEN {_keyword(text)} IS NOT NULL "
        f"THEN concat('Sensitive keyword ''', {_keyword(text)}, ''' detected in customer message') "
        f"WHEN {conf} < 0.6 THEN concat('Low intent classifier confidence (', {_shown(conf)}, ' < 0.6)') "
        f"WHEN {conf} >= 0.85 THEN concat('High confidence ', {name}, ' (', {_shown(conf)}, ') with standard resolution path') "
        f"ELSE concat('Standard ', {name}, ' query (', {_shown(conf)}, ') routed to automated guidance') END"
    )


def _words(c: str) -> str:
    return f"string_split_regex({_strip(c)}, '[{_SPACE}]+')"


def _word_count(c: str) -> str:
    return f"CASE WHEN {_strip(c)} = '' THEN 0 ELSE len({_words(c)}) END"


def _cap(c: str, n: int) -> str:
    cut = rf"regexp_replace(array_to_string(list_slice({_words(c)}, 1, {n}), ' '), '[,;:\-{_SPACE}]+$', '')"
    return (
        f"CASE WHEN {_word_count(c)} <= {n} THEN {c} WHEN right({cut}, 1) IN ('.', '!', '?') THEN {cut} "
        f"ELSE concat({cut}, '.') END"
    )


def _has(c: str, parts) -> str:
    return "(" + " OR ".join(f"contains(lower({c}), '{p}')" for p in parts) + ")"


def _flag(c: str) -> str:
    return f"(lower({c}) IN ('true', '1', 't'))"


def _f2(c: str, d: int) -> str:
    return f"CAST(printf('%.{d}f', CAST({c} AS DOUBLE)) AS DOUBLE)"


def _key(c: str, seed: str = "42") -> str:
    return f"md5(concat('{seed}:', CAST({c} AS VARCHAR)))"


def _ratio(num: str, den: str) -> str:
    return f"CASE WHEN {den} = 0 THEN CAST(0 AS DOUBLE) ELSE CAST({num} AS DOUBLE) / {den} END"


_POSTS = f"posts AS ({derived.plain(derived.POSTS)})"
_TEXTS = f"texts AS ({derived.plain(derived.TEXTS)})"
_JUDGED = f"judged AS ({derived.plain(derived.JUDGED)})"
_HUMAN = f"human AS (SELECT *, {_f2('(human_correctness + human_helpfulness + human_brand_tone + human_groundedness) / 4.0', 2)} AS human_average_score FROM ({derived.plain(derived.HUMAN)}) h0)"
_INDEX = f"idx AS ({derived.plain(derived.INDEX)})"
_ANSWERS = f"answers AS ({derived.plain(derived.ANSWERS)})"

_CUSTOMERS = f"""{_POSTS}, cleaned AS (SELECT tweet_id, text, {_clean('text')} AS tweet FROM posts WHERE {_flag('inbound')}),
customers AS (SELECT *, {_intent('tweet')} AS intent, (CAST(tweet_id AS BIGINT) % 97) / CAST(97.0 AS DOUBLE) AS confidence FROM cleaned)"""

_REPLIES = f"""{_POSTS}, replies AS (SELECT in_response_to_tweet_id, text AS gold_reply FROM (
  SELECT *, row_number() OVER (PARTITION BY in_response_to_tweet_id ORDER BY created_at, tweet_id) AS rn
  FROM posts WHERE author_id = '{derived.BRAND}' AND in_response_to_tweet_id IS NOT NULL) r0 WHERE rn = 1)"""


def _threads(name: str, chars: int) -> str:
    return f"""{name}_pairs AS (SELECT p.tweet_id, p.created_at, {_clean('p.text')} AS tweet, {_clean('r.gold_reply')} AS gold_reply
  FROM posts p JOIN replies r ON p.tweet_id = r.in_response_to_tweet_id WHERE {_flag('p.inbound')}),
{name}_ranked AS (SELECT *, row_number() OVER (PARTITION BY tweet ORDER BY created_at, tweet_id) AS rn
  FROM {name}_pairs WHERE length(tweet) >= {chars} AND length(gold_reply) >= {chars}),
{name} AS (SELECT tweet_id, tweet, gold_reply, {_intent('tweet')} AS intent FROM {name}_ranked WHERE rn = 1)"""


_THREADS = f"{_REPLIES}, {_threads('threads', 20)}, labelled AS (SELECT * FROM threads WHERE intent IS NOT NULL)"


def _split_rows(source: str, id_column: str, label: str) -> str:
    """Per class: counts, then ranked rows with their split."""
    return f"""counted AS (SELECT *, count(*) OVER (PARTITION BY {label}) AS n,
  row_number() OVER (PARTITION BY {label} ORDER BY {_key(id_column)}, {id_column}) AS rn FROM {source}),
bounded AS (SELECT *, least(floor(n * CAST(0.6 AS DOUBLE)), 900) AS b1, least(floor(n * CAST(0.2 AS DOUBLE)), 225) AS b2 FROM counted),
split_rows AS (SELECT *, CASE WHEN rn <= b1 THEN 'train' WHEN rn <= b1 + b2 THEN 'validation'
  WHEN rn <= b1 + 2 * b2 THEN 'test' END AS split FROM bounded)"""


def _capped(id_column: str, totals: dict[str, int]) -> str:
    whens = " ".join(f"WHEN '{k}' THEN {v}" for k, v in totals.items())
    return f"""capped AS (SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY split ORDER BY {_key(id_column, '42:total')}, {id_column}) AS place
  FROM split_rows WHERE split IS NOT NULL) c0 WHERE place <= CASE split {whens} END)"""


_TOTALS = {"train": 8000, "validation": 2000, "test": 2000}
_SPLITS = f"""{_THREADS}, {_split_rows('labelled', 'tweet_id', 'intent')}, {_capped('tweet_id', _TOTALS)},
splits AS (SELECT split, tweet_id, tweet, gold_reply, intent,
  CASE WHEN split = 'test' THEN {_decision('tweet', 'intent', '0.9')} END AS escalate,
  CASE WHEN split = 'test' THEN {_reason('tweet', 'intent', 'CAST(0.9 AS DOUBLE)')} END AS reason FROM capped)"""

_EVAL_COLUMNS = f"""tweet_id, tweet, intent, gold_reply, {_decision('tweet', 'intent', '0.9')} AS escalate,
 {_reason('tweet', 'intent', 'CAST(0.9 AS DOUBLE)')} AS reason"""


def _topped_up(source: str, out: str, per_class: int, total: int) -> str:
    return f"""{out}_in AS (SELECT * FROM {source} WHERE intent IS NOT NULL),
{out}_class AS (SELECT *, row_number() OVER (PARTITION BY intent ORDER BY {_key('tweet_id')}, tweet_id) AS class_rank FROM {out}_in),
{out} AS (SELECT * FROM {out}_class ORDER BY CASE WHEN class_rank <= {per_class} THEN 0 ELSE 1 END,
  CASE WHEN class_rank <= {per_class} THEN {_key('tweet_id', '42:total')} ELSE {_key('tweet_id', '42:more')} END, tweet_id LIMIT {total})"""


def _balanced(source: str, out: str, per_class: int, total: int) -> str:
    return f"""{out}_class AS (SELECT *, row_number() OVER (PARTITION BY intent ORDER BY {_key('tweet_id')}, tweet_id) AS class_rank
  FROM {source} WHERE intent IS NOT NULL),
{out} AS (SELECT * FROM {out}_class WHERE class_rank <= {per_class} ORDER BY {_key('tweet_id', '42:total')}, tweet_id LIMIT {total})"""


_GOLDEN = f"""{_SPLITS}, {_threads('long_threads', 25)},
golden_pool AS (SELECT t.* FROM long_threads t WHERE NOT EXISTS (SELECT 1 FROM splits s WHERE s.split <> 'test' AND s.tweet = t.tweet)),
{_topped_up('golden_pool', 'golden', 23, 200)}"""
_FRESH = f"""{_GOLDEN},
fresh_pool AS (SELECT t.* FROM labelled t WHERE NOT EXISTS (SELECT 1 FROM splits s WHERE s.split <> 'test' AND s.tweet = t.tweet)
  AND NOT EXISTS (SELECT 1 FROM golden g WHERE g.tweet = t.tweet)),
{_balanced('fresh_pool', 'fresh', 2000 // 9 + 5, 2000)}"""

_DOC_SPLITS = f"docs AS (SELECT doc_id, lang FROM documents), {_split_rows('docs', 'doc_id', 'lang')}"


def _hits(queries: str, index: str, query_id: str, index_id: str) -> str:
    """Brute force: every pair, ranked by rounded similarity, then id."""
    return f"""scored AS (SELECT q.{query_id} AS query_id, i.{index_id} AS id,
  round(list_inner_product(CAST(q.embedding AS DOUBLE[]), CAST(i.embedding AS DOUBLE[]))
    / sqrt(list_inner_product(CAST(q.embedding AS DOUBLE[]), CAST(q.embedding AS DOUBLE[])))
    / sqrt(list_inner_product(CAST(i.embedding AS DOUBLE[]), CAST(i.embedding AS DOUBLE[]))), 6) AS similarity
  FROM {queries} q CROSS JOIN {index} i),
hits AS (SELECT * FROM (SELECT *, CAST(row_number() OVER (PARTITION BY query_id ORDER BY similarity DESC, id) AS INTEGER) AS rank FROM scored) s0 WHERE rank <= 5)"""


_CONTEXT = f"{_INDEX}, {_hits('idx', 'idx', 'id', 'id')}, found AS (SELECT h.query_id, h.rank, h.similarity, i.tweet, i.apple_reply, i.intent FROM hits h JOIN idx i ON h.id = i.id)"
_EXAMPLES = """string_agg(concat('Example ', CAST(rank AS VARCHAR), ':', chr(10), 'Q: ', tweet, chr(10), 'A: ', apple_reply), concat(chr(10), chr(10)) ORDER BY rank)"""

_PAIRS = f"{_JUDGED}, pairs AS (SELECT truth, predicted, count(*) AS n FROM judged GROUP BY truth, predicted)"
_PER_LABEL = f"""{_PAIRS}, names AS (SELECT truth AS label FROM pairs UNION SELECT predicted FROM pairs),
cells AS (SELECT label, (SELECT coalesce(sum(n), 0) FROM pairs WHERE truth = label AND predicted = label) AS tp,
  (SELECT coalesce(sum(n), 0) FROM pairs WHERE truth = label) AS support,
  (SELECT coalesce(sum(n), 0) FROM pairs WHERE predicted = label) AS selected FROM names),
per_label AS (SELECT label, {_ratio('tp', 'selected')} AS "precision", {_ratio('tp', 'support')} AS recall,
  {_ratio('2 * tp', '(support + selected)')} AS f1, CAST(support AS BIGINT) AS support FROM cells)"""
_BINARY = f"""{_JUDGED}, b AS (SELECT count(*) FILTER (WHERE truth_route = 'ESCALATE' AND route = 'ESCALATE') AS tp,
  count(*) FILTER (WHERE truth_route <> 'ESCALATE' AND route = 'ESCALATE') AS fp,
  count(*) FILTER (WHERE truth_route = 'ESCALATE' AND route <> 'ESCALATE') AS fn,
  count(*) FILTER (WHERE truth_route <> 'ESCALATE' AND route <> 'ESCALATE') AS tn FROM judged)"""


def _judge_scores(c: str) -> str:
    return f"""CASE WHEN {_word_count(c)} > 70 THEN 4 ELSE 5 END AS correctness,
 CASE WHEN {_has(c, fixed.HELPFUL_TOKENS)} THEN 5 ELSE 4 END AS helpfulness,
 CASE WHEN {_has(c, fixed.TONE_TOKENS)} THEN 5 ELSE 4 END AS brand_tone,
 CASE WHEN length({c}) > 20 THEN 5 ELSE 3 END AS groundedness"""


_MEAN4 = _f2("(correctness + helpfulness + brand_tone + groundedness) / 4.0", 2)
_SCORED = f"""{_HUMAN}, marks AS (SELECT doc_id, human_average_score, {_judge_scores('text')} FROM human),
scored AS (SELECT *, {_MEAN4} AS average_score FROM marks)"""

_DOCUMENT = f"""{_PER_LABEL.replace('cells AS', 'label_cells AS').replace('FROM cells', 'FROM label_cells')}, {_BINARY.split('), b AS', 1)[1].join(['b AS', ''])},
{_SCORED}
SELECT 'events' AS dataset,
 {_f2('(SELECT avg(CASE WHEN truth = predicted THEN 1.0 ELSE 0.0 END) FROM judged)', 4)} AS accuracy,
 {_f2('(SELECT avg("precision") FROM per_label)', 4)} AS precision_macro, {_f2('(SELECT avg(recall) FROM per_label)', 4)} AS recall_macro,
 {_f2('(SELECT avg(f1) FROM per_label)', 4)} AS macro_f1, (SELECT count(*) FROM judged) AS eval_samples,
 {_f2('CAST(tp + tn AS DOUBLE) / (tp + fp + fn + tn)', 4)} AS escalation_accuracy,
 {_f2(_ratio('tp', '(tp + fp)'), 4)} AS "precision", {_f2(_ratio('tp', '(tp + fn)'), 4)} AS recall,
 {_f2(_ratio('2 * tp', '(2 * tp + fp + fn)'), 4)} AS f1_score,
 {_f2('(SELECT avg(correctness) FROM scored)', 2)} AS mean_correctness,
 {_f2('(SELECT avg(average_score) FROM scored)', 2)} AS mean_composite_score,
 (SELECT count(*) FROM scored) AS total_evaluated, (SELECT count(*) FROM scored) AS sample_size,
 {_f2('(SELECT avg(abs(human_average_score - average_score)) FROM scored)', 3)} AS mean_absolute_error
FROM b"""

_TOKENS = r"regexp_extract_all(lower(text), '[\p{L}\p{N}_]{2,}')"

_MODELS = f"""{_JUDGED}, long_rows AS (SELECT 'by_value' AS model, truth, predicted, truth_route, route FROM judged
  UNION ALL SELECT 'always_view', truth, 'view', truth_route, 'AUTO' FROM judged
  UNION ALL SELECT 'perfect', truth, truth, truth_route, truth_route FROM judged)"""


def _comparison(source: str) -> str:
    """One row per model of a long table (model, truth, predicted, truth_route, route)."""
    return f"""model_labels AS (SELECT model, truth AS label FROM {source} UNION SELECT model, predicted FROM {source}),
model_f1 AS (SELECT l.model, l.label, 2 * count(*) FILTER (WHERE r.truth = l.label AND r.predicted = l.label) AS num,
  count(*) FILTER (WHERE r.truth = l.label) + count(*) FILTER (WHERE r.predicted = l.label) AS den
  FROM model_labels l JOIN {source} r ON r.model = l.model GROUP BY l.model, l.label),
macro AS (SELECT model, avg({_ratio('num', 'den')}) AS f FROM model_f1 GROUP BY model),
overall AS (SELECT model, avg(CASE WHEN truth = predicted THEN 1.0 ELSE 0.0 END) AS acc,
  count(*) FILTER (WHERE truth_route = 'ESCALATE' AND route = 'ESCALATE') AS tp,
  count(*) FILTER (WHERE truth_route <> 'ESCALATE' AND route = 'ESCALATE') AS fp,
  count(*) FILTER (WHERE truth_route = 'ESCALATE' AND route <> 'ESCALATE') AS fn FROM {source} GROUP BY model)
SELECT o.model, acc AS intent_accuracy, round(f, 9) AS intent_macro_f1, {_ratio('tp', '(tp + fn)')} AS escalation_recall,
 {_ratio('2 * tp', '(2 * tp + fp + fn)')} AS escalation_f1 FROM overall o JOIN macro m ON o.model = m.model"""


_MAJORITY = f"""{_SPLITS}, top AS (SELECT intent FROM splits WHERE split = 'train' GROUP BY intent ORDER BY count(*) DESC, intent LIMIT 1),
long_rows AS (SELECT 'majority' AS model, intent AS truth, (SELECT intent FROM top) AS predicted, escalate AS truth_route, 'AUTO' AS route
  FROM splits WHERE split = 'test')"""


def _int_score(name: str) -> str:
    v = f"json_extract_string(answer, '$.{name}')"
    return f"coalesce(CAST(trunc(TRY_CAST({v} AS DOUBLE)) AS INTEGER), 4)"


def _bad_score(name: str) -> str:
    v = f"json_extract_string(answer, '$.{name}')"
    return f"({v} IS NOT NULL AND TRY_CAST({v} AS DOUBLE) IS NULL)"


_PARSED = f"""{_ANSWERS}, valid AS (SELECT event_id, generated_reply, CASE WHEN json_valid(answer) THEN answer END AS answer FROM answers),
checked AS (SELECT *, (answer IS NULL OR {' OR '.join(_bad_score(n) for n in fixed.RUBRIC)}) AS bad FROM valid),
parsed AS (SELECT event_id, {', '.join(f"{_int_score(n)} AS {n}" for n in fixed.RUBRIC)}, json_extract_string(answer, '$.explanation') AS explanation FROM checked WHERE NOT bad
 UNION ALL SELECT event_id, {', '.join(s.split(' AS ')[0] for s in _judge_scores('generated_reply').split(chr(10)) if s).replace(',,', ',')}, {_quote(fixed.HEURISTIC_EXPLANATION)} FROM checked WHERE bad)"""

_RULE_PREDICTIONS = f"""SELECT tweet_id, tweet, intent, CAST(0.9 AS DOUBLE) AS confidence, {_cap('gold_reply', 6)} AS generated_reply,
 {_decision('tweet', 'intent', '0.9')} AS decision, {_reason('tweet', 'intent', 'CAST(0.9 AS DOUBLE)')} AS reason FROM labelled"""


def _fill(template: str, **values: str) -> str:
    parts = re.split(r"\{(\w+)\}", template)
    return "concat(" + ", ".join(values[p] if i % 2 else _quote(p) for i, p in enumerate(parts)) + ")"


_LENGTHS = "sqrt(list_inner_product(CAST(embedding AS DOUBLE[]), CAST(embedding AS DOUBLE[])))"

ORACLE: dict[str, str] = {
    # sources and sinks
    "scan_posts": f"WITH {_POSTS} SELECT tweet_id, author_id, inbound, substr(CAST(created_at AS VARCHAR), 1, 19) AS created_at, text, response_tweet_id, in_response_to_tweet_id FROM posts",
    "scan_labelled": f"WITH {_THREADS} SELECT tweet, gold_reply, intent FROM labelled",
    "scan_human_review": f"WITH {_HUMAN} SELECT text AS tweet, 'app_store' AS intent, text AS gold_reply, 'AUTO' AS escalate, 'none' AS reason, human_correctness, human_helpfulness, human_brand_tone, human_groundedness, human_average_score FROM human",
    "scan_messages": "SELECT doc_id, coalesce(text, '') AS text FROM documents",
    "sink_predictions": f"WITH {_THREADS} {_RULE_PREDICTIONS}",
    "sink_splits": f"WITH {_SPLITS} SELECT split, tweet_id, tweet, gold_reply, intent FROM splits",
    "sink_metrics": f"WITH doc AS (WITH {_DOCUMENT}) SELECT dataset, accuracy, f1_score FROM doc",
    "scan_metrics": f"WITH {_DOCUMENT}",
    "sink_vector_table": f"WITH {_INDEX} SELECT id, tweet, apple_reply, intent, CAST(len(embedding) AS INTEGER) AS width FROM idx",
    "stage_skip": f"WITH {_CUSTOMERS} SELECT intent, count(*) AS n FROM customers WHERE intent IS NOT NULL GROUP BY intent",
    # projections and filters
    "parse_inbound": f"WITH {_POSTS} SELECT tweet_id, {_flag('inbound')} AS inbound FROM posts",
    "brand_replies": f"WITH {_POSTS} SELECT tweet_id, text, in_response_to_tweet_id FROM posts WHERE author_id = 'Support'",
    "drop_nulls": f"WITH {_POSTS} SELECT tweet_id, in_response_to_tweet_id FROM posts WHERE in_response_to_tweet_id IS NOT NULL",
    "min_length": f"WITH {_TEXTS} SELECT text_id, CAST(length(text) AS INTEGER) AS n_chars FROM texts WHERE length(text) >= 20",
    "mostly_ascii": rf"WITH {_TEXTS} SELECT text_id, CASE WHEN length({_strip('text')}) < 5 THEN FALSE ELSE length(regexp_replace(text, '[^\x00-\x7F]', '', 'g')) / length(text) > CAST(0.85 AS DOUBLE) END AS ascii FROM texts",
    "inbound_only": f"WITH {_POSTS} SELECT tweet_id, author_id FROM posts WHERE {_flag('inbound')}",
    "project_thread": f"WITH {_THREADS} SELECT tweet, gold_reply, intent FROM labelled",
    "default_column": "SELECT conv_id, turn, role, 'AUTO' AS escalate, '' AS gold_reply, 'general_inquiry' AS intent FROM conversations",
    "sanitize_text": f"WITH {_TEXTS}, padded AS (SELECT text_id, concat(' ', chr(160), chr(9), text, ' ', chr(10), chr(8195)) AS p FROM texts) SELECT text_id, {_strip('p')} AS query, CASE WHEN {_strip('left(p, 4)')} = '' THEN ' ' ELSE left(p, 4) END AS encoded FROM padded",
    "escalated_flag": f"WITH {_JUDGED} SELECT event_id, CASE WHEN route = 'ESCALATE' THEN 1 ELSE 0 END AS escalated FROM judged",
    # joins
    "thread_pairs": f"WITH {_REPLIES} SELECT p.tweet_id, p.text, r.gold_reply FROM posts p JOIN replies r ON p.tweet_id = r.in_response_to_tweet_id WHERE {_flag('p.inbound')}",
    "thread_pairs_arriving": f"WITH {_REPLIES} SELECT p.tweet_id, p.text, r.gold_reply FROM posts p JOIN replies r ON p.tweet_id = r.in_response_to_tweet_id WHERE {_flag('p.inbound')}",
    "turn_pairs": "SELECT conv_id, turn, text AS tweet, reply AS gold_reply FROM (SELECT *, lead(text) OVER w AS reply, lead(role) OVER w AS next_role FROM conversations WINDOW w AS (PARTITION BY conv_id ORDER BY turn, role NULLS FIRST, text NULLS FIRST)) t WHERE role = 'user' AND next_role = 'assistant'",
    "holdout_anti": "SELECT doc_id FROM documents d WHERE NOT EXISTS (SELECT 1 FROM benchmark b WHERE b.text = d.text) AND NOT EXISTS (SELECT 1 FROM documents u JOIN labels l ON u.doc_id = l.doc_id WHERE l.quality = 0 AND u.text = d.text)",
    "holdout_anti_filtered": "SELECT doc_id FROM documents d WHERE NOT EXISTS (SELECT 1 FROM benchmark b WHERE b.text = d.text) AND NOT EXISTS (SELECT 1 FROM documents u JOIN labels l ON u.doc_id = l.doc_id WHERE l.quality = 0 AND u.text = d.text)",
    "topup_anti": f"WITH {_CUSTOMERS}, ranked AS (SELECT *, row_number() OVER (PARTITION BY intent ORDER BY {_key('tweet_id')}, tweet_id) AS rn FROM customers WHERE intent IS NOT NULL) SELECT tweet_id, intent FROM ranked WHERE rn > 23",
    "topk_retrieve": f"WITH {_hits('embeddings', 'embeddings', 'vec_id', 'vec_id')} SELECT query_id, rank, id, similarity FROM hits",
    "topk_retrieve_large": f"WITH {_hits('embeddings', 'embeddings', 'vec_id', 'vec_id')} SELECT query_id, rank, id, similarity FROM hits",
    "attach_metadata": f"WITH {_INDEX}, {_hits('embeddings', 'idx', 'vec_id', 'id')} SELECT h.query_id, h.rank, h.id, h.similarity, i.tweet, i.apple_reply, i.intent FROM hits h JOIN idx i ON h.id = i.id",
    "attach_metadata_buckets": f"WITH {_INDEX}, {_hits('embeddings', 'idx', 'vec_id', 'id')} SELECT h.query_id, h.rank, h.id, h.similarity, i.tweet, i.apple_reply, i.intent FROM hits h JOIN idx i ON h.id = i.id",
    "attach_truth": f"WITH {_THREADS} SELECT tweet_id, intent, CASE WHEN CAST(tweet_id AS BIGINT) % 3 = 0 THEN 'general_inquiry' ELSE intent END AS ground_truth_intent, 'AUTO' AS ground_truth_escalate, '' AS gold_reply FROM labelled",
    "label_decode": f"WITH {_CUSTOMERS} SELECT tweet_id, CAST(list_position({sorted(fixed.INTENTS)}, intent) - 1 AS DOUBLE) AS label_index, intent AS decoded FROM customers WHERE intent IS NOT NULL",
    # aggregations
    "intent_counts": f"WITH {_CUSTOMERS} SELECT intent, count(*) AS n FROM customers WHERE intent IS NOT NULL GROUP BY intent",
    "majority_class": f"WITH {_CUSTOMERS} SELECT intent, count(*) AS n FROM customers WHERE intent IS NOT NULL GROUP BY intent ORDER BY n DESC, intent LIMIT 1",
    "accuracy": f"WITH {_JUDGED} SELECT round(avg(CASE WHEN truth = predicted THEN 1.0 ELSE 0.0 END), 9) AS accuracy FROM judged",
    "macro_prf": f"WITH {_PER_LABEL} SELECT round(avg(\"precision\"), 9) AS precision_macro, round(avg(recall), 9) AS recall_macro, round(avg(f1), 9) AS macro_f1 FROM per_label",
    "binary_prf": f"WITH {_BINARY} SELECT CAST(tp + tn AS DOUBLE) / (tp + fp + fn + tn) AS accuracy, {_ratio('tp', '(tp + fp)')} AS \"precision\", {_ratio('tp', '(tp + fn)')} AS recall, {_ratio('2 * tp', '(2 * tp + fp + fn)')} AS f1_score, tp + fp + fn + tn AS eval_samples FROM b",
    "class_report": f"""WITH {_PER_LABEL} SELECT label, round("precision", 9) AS "precision", round(recall, 9) AS recall, round(f1, 9) AS f1, support FROM per_label
UNION ALL SELECT 'accuracy', round(a, 9), round(a, 9), round(a, 9), s FROM (SELECT CAST(sum(CASE WHEN truth = predicted THEN n ELSE 0 END) AS DOUBLE) / sum(n) AS a, CAST(sum(n) AS BIGINT) AS s FROM pairs) x
UNION ALL SELECT 'macro avg', round(avg("precision"), 9), round(avg(recall), 9), round(avg(f1), 9), CAST(sum(support) AS BIGINT) FROM per_label
UNION ALL SELECT 'weighted avg', round(sum("precision" * support) / sum(support), 9), round(sum(recall * support) / sum(support), 9), round(sum(f1 * support) / sum(support), 9), CAST(sum(support) AS BIGINT) FROM per_label""",
    "confusion_matrix": f"WITH {_PAIRS}, names AS (SELECT truth AS label FROM pairs UNION SELECT predicted FROM pairs) SELECT t.label AS truth, p.label AS predicted, coalesce(c.n, 0) AS n, {_ratio('coalesce(c.n, 0)', 'coalesce((SELECT sum(n) FROM pairs x WHERE x.truth = t.label), 0)')} AS share FROM names t CROSS JOIN names p LEFT JOIN pairs c ON c.truth = t.label AND c.predicted = p.label",
    "judge_summary": f"WITH {_SCORED} SELECT {', '.join(_f2(f'avg({n})', 2) + f' AS mean_{n}' for n in fixed.RUBRIC)}, {_f2('avg(average_score)', 2)} AS mean_composite_score, count(*) AS total_evaluated FROM scored",
    "human_agreement": f"WITH {_SCORED} SELECT count(*) AS sample_size, round(corr(human_average_score, average_score), 9) AS pearson_correlation, round(avg(abs(human_average_score - average_score)), 9) AS mean_absolute_error, round(avg(CASE WHEN abs(human_average_score - average_score) <= 1 THEN 1.0 ELSE 0.0 END) * 100, 9) AS agreement_within_1_point_pct, round(avg(human_average_score), 9) AS human_mean_score, round(avg(average_score), 9) AS judge_mean_score FROM scored",
    "baseline_majority": f"WITH {_MAJORITY}, {_comparison('long_rows')}",
    "class_weights": f"WITH {_CUSTOMERS}, c AS (SELECT intent, count(*) AS n FROM customers WHERE intent IS NOT NULL GROUP BY intent) SELECT intent, n, round(CAST((SELECT sum(n) FROM c) AS DOUBLE) / ((SELECT count(*) FROM c) * n), 9) AS weight FROM c",
    "term_stats": f"""WITH t AS (SELECT doc_id, {_TOKENS} AS w FROM documents),
grams AS (SELECT doc_id, unnest(w) AS term FROM t UNION ALL SELECT doc_id, unnest(list_transform(range(1, len(w)), lambda i: concat(w[i], ' ', w[i + 1]))) FROM t)
SELECT term, count(*) AS tf, count(DISTINCT doc_id) AS df FROM grams GROUP BY term ORDER BY tf DESC, term LIMIT 5000""",
    "term_stats_large": f"""WITH t AS (SELECT doc_id, {_TOKENS} AS w FROM documents),
grams AS (SELECT doc_id, unnest(w) AS term FROM t UNION ALL SELECT doc_id, unnest(list_transform(range(1, len(w)), lambda i: concat(w[i], ' ', w[i + 1]))) FROM t)
SELECT term, count(*) AS tf, count(DISTINCT doc_id) AS df FROM grams GROUP BY term ORDER BY tf DESC, term LIMIT 5000""",
    "compare_models": f"WITH {_MODELS}, {_comparison('long_rows')}",
    "human_mean": f"WITH {_HUMAN} SELECT doc_id, human_average_score FROM human",
    "split_overlap": """WITH l AS (SELECT d.doc_id, d.text, l.quality FROM documents d JOIN labels l ON d.doc_id = l.doc_id),
s AS (SELECT DISTINCT 1 AS i, 'documents' AS split, text FROM documents UNION ALL SELECT DISTINCT 2, 'good', text FROM l WHERE quality = 1
 UNION ALL SELECT DISTINCT 3, 'poor', text FROM l WHERE quality = 0 UNION ALL SELECT DISTINCT 4, 'benchmark', text FROM benchmark),
names AS (SELECT DISTINCT i, split FROM s)
SELECT a.split AS split_a, b.split AS split_b, (SELECT count(*) FROM s x JOIN s y ON x.text = y.text WHERE x.i = a.i AND y.i = b.i) AS shared FROM names a JOIN names b ON a.i < b.i""",
    "metrics_document": f"WITH {_DOCUMENT}",
    "score_distribution": f"WITH {_CUSTOMERS}, routed AS (SELECT coalesce(intent, 'none') AS intent, {_decision('tweet', 'intent', 'confidence')} AS decision FROM customers) SELECT intent, decision, count(*) AS n FROM routed GROUP BY intent, decision",
    "score_distribution_arriving": f"WITH {_CUSTOMERS}, routed AS (SELECT coalesce(intent, 'none') AS intent, {_decision('tweet', 'intent', 'confidence')} AS decision FROM customers) SELECT intent, decision, count(*) AS n FROM routed GROUP BY intent, decision",
    # de-duplication, samples, top-k
    "dedupe_reply_target": f"WITH {_REPLIES} SELECT in_response_to_tweet_id, gold_reply FROM replies",
    "dedupe_text": "SELECT doc_id, lang, source FROM (SELECT *, row_number() OVER (PARTITION BY text ORDER BY doc_id) AS rn FROM documents) d WHERE rn = 1",
    "stratified_split": f"WITH {_DOC_SPLITS} SELECT doc_id, lang, split FROM split_rows WHERE split IS NOT NULL",
    "cap_split": f"WITH {_DOC_SPLITS}, {_capped('doc_id', {'train': 300, 'validation': 90, 'test': 80})} SELECT doc_id, lang, split FROM capped",
    "stratified_sample": f"WITH {_CUSTOMERS}, {_balanced('customers', 'picked', 2000 // 9 + 5, 2000)} SELECT tweet_id, intent FROM picked",
    "topup_sample": f"WITH {_CUSTOMERS}, {_topped_up('customers', 'picked', 20, 200)} SELECT tweet_id, intent FROM picked",
    "review_sample": f"WITH {_CUSTOMERS} SELECT tweet_id, tweet FROM customers ORDER BY {_key('tweet_id')}, tweet_id LIMIT 30",
    "topk_per_query": "SELECT o_custkey, o_orderkey, o_totalprice, rank FROM (SELECT *, CAST(row_number() OVER (PARTITION BY o_custkey ORDER BY o_totalprice DESC, o_orderkey) AS INTEGER) AS rank FROM orders) o WHERE rank <= 5",
    "argmax_class": "SELECT vec_id, concat('class_', CAST(list_position(embedding, list_max(embedding)) - 1 AS VARCHAR)) AS intent, round(CAST(list_max(embedding) AS DOUBLE), 6) AS confidence FROM embeddings",
    "sorted_labels": f"WITH {_JUDGED} SELECT truth AS label FROM judged UNION SELECT predicted FROM judged ORDER BY label",
    "preview": "SELECT doc_id, lang, n_chars FROM documents ORDER BY doc_id LIMIT 3",
    # set operations
    "concat_groups": f"WITH {_JUDGED} SELECT event_id, nullif(truth, 'error') AS truth, CASE WHEN truth NOT IN ('view', 'error') THEN true END AS other FROM judged",
    "used_texts": "SELECT text FROM documents WHERE text IS NOT NULL UNION SELECT text FROM benchmark WHERE text IS NOT NULL UNION SELECT text FROM conversations WHERE text IS NOT NULL",
    "label_union": f"WITH {_JUDGED} SELECT truth AS label FROM judged UNION SELECT predicted FROM judged",
    # text
    "clean_text": f"WITH {_TEXTS} SELECT text_id, {_clean('text')} AS cleaned FROM texts",
    "weak_intent": f"WITH {_TEXTS}, c AS (SELECT text_id, {_clean('text')} AS t FROM texts) SELECT text_id, {_intent('t')} AS intent FROM c",
    "match_keyword": f"WITH {_TEXTS} SELECT text_id, {_keyword('text')} AS keyword FROM texts",
    "keyword_contains": f"WITH {_CUSTOMERS} SELECT tweet_id, CASE WHEN coalesce(intent, '') IN {_in(fixed.RISKY_INTENTS)} OR {_has('tweet', fixed.BASELINE_KEYWORDS)} THEN 'ESCALATE' ELSE 'AUTO' END AS decision FROM customers",
    "readable_intent": f"WITH {_CUSTOMERS} SELECT tweet_id, replace(intent, '_', ' ') AS intent FROM customers",
    "word_count": f"WITH {_TEXTS} SELECT text_id, CAST({_word_count('text')} AS INTEGER) AS n_words FROM texts",
    "cap_words": f"WITH {_TEXTS} SELECT text_id, {_cap('text', 70)} AS capped FROM texts",
    "context_block": f"WITH {_CONTEXT} SELECT query_id AS id, string_agg(concat('[Example ', CAST(rank AS VARCHAR), '] (Intent: ', intent, ', Relevance: ', {_shown('similarity')}, ')', chr(10), 'Customer: ', tweet, chr(10), 'Apple Support Reply: ', apple_reply), concat(chr(10), chr(10)) ORDER BY rank) AS context FROM found GROUP BY query_id",
    "prompt_examples": f"WITH {_CONTEXT} SELECT query_id AS id, {_EXAMPLES} AS examples FROM found GROUP BY query_id",
    "build_prompts": f"""WITH {_CONTEXT}, listed AS (SELECT query_id, {_EXAMPLES} AS examples, max(CASE WHEN rank = 1 THEN apple_reply END) AS best FROM found GROUP BY query_id)
SELECT i.id, {_fill(fixed.REPLY_PROMPT, tweet='i.tweet', intent='i.intent', context='l.examples')} AS reply_prompt,
 {_fill(fixed.JUDGE_PROMPT, tweet='i.tweet', intent='i.intent', gold_reply="'none'", generated_reply='l.best')} AS judge_prompt
FROM idx i JOIN listed l ON i.id = l.query_id""",
    "parse_judge_json": f"WITH {_PARSED} SELECT event_id, correctness, helpfulness, brand_tone, groundedness, {_MEAN4} AS average_score, explanation FROM parsed",
    # numbers and vectors
    "l2_normalize": f"WITH v AS (SELECT vec_id, embedding, {_LENGTHS} AS len FROM embeddings), x AS (SELECT vec_id, len, unnest(range(0, 64)) AS pos, unnest(CAST(embedding AS DOUBLE[])) AS x FROM v) SELECT vec_id, CAST(pos AS INTEGER) AS pos, round(x / len, 6) AS x FROM x",
    "cosine": "SELECT a.vec_id, round(list_inner_product(CAST(a.embedding AS DOUBLE[]), CAST(b.embedding AS DOUBLE[])) / sqrt(list_inner_product(CAST(a.embedding AS DOUBLE[]), CAST(a.embedding AS DOUBLE[])) * list_inner_product(CAST(b.embedding AS DOUBLE[]), CAST(b.embedding AS DOUBLE[]))), 6) AS similarity FROM embeddings a JOIN embeddings b ON a.vec_id = b.vec_id - 1",
    "row_share": f"WITH {_JUDGED} SELECT truth_route AS truth, route AS predicted, CAST(count(*) AS DOUBLE) / sum(count(*)) OVER (PARTITION BY truth_route) AS share FROM judged GROUP BY truth_route, route",
    "abs_error": f"WITH {_SCORED} SELECT doc_id, abs(human_average_score - average_score) AS gap, abs(human_average_score - average_score) <= 1 AS within_one FROM scored",
    "normalize_check": f"SELECT CAST(len(embedding) AS INTEGER) AS width, count(*) AS n, CAST(sum(CASE WHEN abs({_LENGTHS} - 1) < 0.001 THEN 1 ELSE 0 END) AS BIGINT) AS n_unit FROM embeddings GROUP BY width",
    # decisions and scores
    "route": f"WITH {_CUSTOMERS} SELECT tweet_id, {_decision('tweet', 'intent', 'confidence')} AS decision, {_reason('tweet', 'intent', 'confidence')} AS reason FROM customers",
    "label_escalation": f"WITH {_CUSTOMERS} SELECT tweet_id, {_decision('tweet', 'intent', '0.9')} AS escalate, {_reason('tweet', 'intent', 'CAST(0.9 AS DOUBLE)')} AS reason FROM customers WHERE intent IS NOT NULL",
    "draft_reply": f"WITH {_CONTEXT} SELECT query_id AS id, {_cap('apple_reply', 4)} AS reply FROM found WHERE rank = 1",
    "heuristic_judge": f"WITH {_TEXTS}, m AS (SELECT text_id, {_judge_scores('text')} FROM texts) SELECT *, {_MEAN4} AS average_score FROM m",
    # models
    "prob_map": "SELECT vec_id, CAST((SELECT count(DISTINCT label) FROM embeddings) AS INTEGER) AS classes, true AS agrees FROM embeddings",
    "embed": f"SELECT doc_id, 384 AS width, CASE WHEN len({_TOKENS}) = 0 THEN CAST(0 AS DOUBLE) ELSE CAST(1 AS DOUBLE) END AS norm, CAST(len(list_distinct({_TOKENS})) AS INTEGER) AS n_words, true AS filled FROM documents",
    "baseline_majority_fit": f"WITH {_MAJORITY} SELECT truth, predicted, truth_route, route, count(*) AS n FROM long_rows GROUP BY truth, predicted, truth_route, route",
    "fit_index": f"WITH {_SPLITS} SELECT tweet_id AS id, tweet, gold_reply AS apple_reply, intent, 384 AS width FROM labelled l WHERE NOT EXISTS (SELECT 1 FROM splits s WHERE s.split <> 'train' AND s.tweet = l.tweet)",
    "scan_evaluation": f"WITH {_THREADS} SELECT {_EVAL_COLUMNS.replace('tweet_id, ', '', 1)} FROM labelled",
    "confidence": "SELECT vec_id, true AS agrees FROM embeddings",
    "predict_intent": "SELECT vec_id, true AS agrees FROM embeddings",
    "model_save_load": "SELECT vec_id, true AS same FROM embeddings",
    "train_intent": f"WITH {_SPLITS} SELECT count(*) FILTER (WHERE split = 'train') AS n_train, count(DISTINCT intent) FILTER (WHERE split = 'train') AS n_classes, true AS optimal, count(*) FILTER (WHERE split = 'validation') AS n_validation, count(*) FILTER (WHERE split = 'validation') AS n_reported FROM splits",
    "baseline_tfidf_svm": f"WITH {_SPLITS} SELECT tweet_id, intent AS truth, true AS known, CAST(0 AS DOUBLE) AS slope, true AS learned FROM splits WHERE split = 'test'",
    "batch_predict": f"WITH {_CUSTOMERS} SELECT tweet_id, true AS routed, 5 AS neighbours, true AS short, true AS grounded FROM customers",
    "predict_file": f"WITH {_POSTS}, asked AS (SELECT {_strip('text')} AS tweet FROM posts WHERE {_flag('inbound')}) SELECT tweet, count(*) AS n, count(*) AS n_ids FROM asked GROUP BY tweet",
    "evaluate_agent": f"WITH {_SPLITS} SELECT count(*) AS eval_samples, true AS all_rows, true AS intents_agree, true AS routes_agree FROM splits WHERE split = 'test'",
    "evaluate_model": f"WITH {_SPLITS} SELECT 'agent' AS model, count(*) AS n, true AS accurate, true AS recalled FROM splits WHERE split = 'test'",
    "compare_baselines": f"WITH {_MAJORITY}, c AS (WITH {_comparison('long_rows')}) SELECT m.model, CASE WHEN m.model = 'majority' THEN CAST(intent_accuracy AS DOUBLE) END AS majority_accuracy, CASE WHEN m.model = 'majority' THEN intent_macro_f1 END AS majority_f1, m.model <> 'majority' AS above_half FROM (VALUES ('majority'), ('tfidf_svm'), ('agent')) m(model), c",
    "run_all": f"WITH {_GOLDEN} SELECT count(*) AS eval_samples, true AS all_rows, true AS intents_agree, true AS routes_agree, (SELECT count(*) FROM labelled l WHERE NOT EXISTS (SELECT 1 FROM splits s WHERE s.split <> 'train' AND s.tweet = l.tweet) AND NOT EXISTS (SELECT 1 FROM golden g WHERE g.tweet = l.tweet)) AS n_index, (SELECT count(*) FROM splits WHERE split = 'validation') AS n_validation FROM golden",
    # composed jobs
    "refresh_threads": f"WITH {_THREADS} SELECT tweet_id, tweet, gold_reply, intent FROM labelled",
    "build_threads": f"WITH {_THREADS} SELECT tweet_id, tweet, gold_reply FROM threads",
    "build_splits": f"WITH {_SPLITS} SELECT * FROM splits",
    "build_golden": f"WITH {_GOLDEN} SELECT {_EVAL_COLUMNS} FROM golden",
    "build_review": f"WITH {_GOLDEN}, picked AS (SELECT tweet_id, CAST(tweet_id AS BIGINT) AS i FROM golden ORDER BY {_key('tweet_id', '42:review')}, tweet_id LIMIT 30), s AS (SELECT tweet_id, CAST(4 + i % 2 AS INTEGER) AS human_correctness, CAST(4 + (i + 1) % 2 AS INTEGER) AS human_helpfulness, CAST(4 + i % 2 AS INTEGER) AS human_brand_tone, CAST(4 + (i + 1) % 2 AS INTEGER) AS human_groundedness FROM picked) SELECT *, {_f2('(human_correctness + human_helpfulness + human_brand_tone + human_groundedness) / 4.0', 2)} AS human_average_score FROM s",
    "build_test": f"WITH {_FRESH} SELECT {_EVAL_COLUMNS} FROM fresh",
    # stream
    "route_stream": f"WITH {_CUSTOMERS} SELECT tweet_id, intent, {_decision('tweet', 'intent', '0.9')} AS decision, {_reason('tweet', 'intent', 'CAST(0.9 AS DOUBLE)')} AS reason FROM customers",
}
