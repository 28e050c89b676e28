"""SQL twins of the operators' queries, where SQL can express them.

The others have hashes or merges that SQL lacks; their tests compare them with plain Python or with the public libraries.
"""

from deskflow.llm import chat

_LOWER = "translate({c}, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"
_WORD = r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+"


def _words(c: str) -> str:
    return f"regexp_extract_all({_LOWER.format(c=f'coalesce({c}, {chr(39) * 2})')}, '{_WORD}')"


_WINDOWS = f"""d AS (SELECT row_number() OVER () AS row, doc_id, {_words('text')} AS w FROM documents),
b AS (SELECT item_id, {_words('text')} AS w FROM benchmark),
b_win AS (SELECT DISTINCT item_id, array_to_string(list_slice(w, s, s + least(10, len(w)) - 1), ' ') AS win, least(10, len(w)) AS size
  FROM (SELECT item_id, w, unnest(range(1, greatest(len(w) - 10, 0) + 2)) AS s FROM b WHERE len(w) > 0) s0),
d_win AS (SELECT row, size, s, array_to_string(list_slice(w, s, s + size - 1), ' ') AS win
  FROM (SELECT row, w, size, unnest(range(1, len(w) - size + 2)) AS s
    FROM d, (SELECT DISTINCT size FROM b_win) z WHERE len(w) >= size) s0),
hits AS (SELECT d_win.row, d_win.s, d_win.size, b_win.item_id FROM d_win JOIN b_win ON d_win.win = b_win.win AND d_win.size = b_win.size),
marked AS (SELECT row, count(DISTINCT p) AS n_hit FROM (SELECT row, unnest(range(s, s + size)) AS p FROM hits) p0 GROUP BY row),
items AS (SELECT row, count(*) AS n_items, string_agg(item, ',' ORDER BY item) AS listed
  FROM (SELECT DISTINCT row, CAST(item_id AS VARCHAR) AS item FROM hits WHERE item_id IS NOT NULL) i0 GROUP BY row)"""

_DECONTAMINATE = f"""WITH {_WINDOWS} SELECT doc_id, CAST(len(w) AS BIGINT) AS n_words, coalesce(n_hit, 0) AS n_hit,
 coalesce(n_items, 0) AS n_items, sha256(coalesce(listed, '')) AS items_sha256, coalesce(n_hit, 0) > 0 AS contaminated
FROM d LEFT JOIN marked USING (row) LEFT JOIN items USING (row)"""

_BITS = "CAST(CAST(unhex(sha1(data)) AS BIT) AS VARCHAR)"
_FIVE = " + ".join(f"{1 << (4 - k)} * CAST(substr(bits, 5 * i + {k + 1}, 1) AS INTEGER)" for k in range(5))
_ARCHIVE = f"""WITH p AS (SELECT page_id, encode(coalesce(html, '')) AS data FROM pages),
q AS (SELECT page_id, octet_length(data) AS n, sha1(data) AS digest, {_BITS} AS bits FROM p),
r AS (SELECT *, max(page_id) OVER (PARTITION BY digest) AS owner FROM q)
SELECT page_id, CAST(n AS BIGINT) AS payload_bytes, array_to_string(list_transform(range(0, 32), lambda i:
  substr('ABCDEFGHIJKLMNOPQRSTUVWXYZ234567', 1 + {_FIVE}, 1)), '') AS payload_digest,
 CASE WHEN page_id = owner THEN 'response' ELSE 'revisit' END AS record_type, CASE WHEN page_id <> owner THEN owner END AS refers_to
FROM r"""

_SAID = "</s>[INST] ok [/INST]"
_INSIDE = "|".join(sorted((c[1:].replace("|", r"\|").replace("[", r"\[").replace("]", r"\]") for c in chat.CONTROLS), key=len,
                          reverse=True))
_ESCAPED = r"regexp_replace({c}, '([<\[])(\\*)(" + _INSIDE + r")', '\1\2\\\3', 'g')"
_CHAT = f"""WITH c AS (SELECT conv_id, turn, coalesce(role, '') AS role, coalesce(text, '') AS text FROM conversations
 UNION ALL SELECT -1, 0, 'user', '{_SAID}' UNION ALL SELECT -1, 1, 'assistant', '{_SAID}')
SELECT conv_id, count(*) AS n_turns, sha256(string_agg(concat(role, chr(10), text, chr(10)), '' ORDER BY turn)) AS turns_sha256,
 CAST(coalesce(sum(length(text)) FILTER (WHERE role = 'assistant'), 0) AS BIGINT) AS loss_chars,
 sha256(coalesce(string_agg(text, '' ORDER BY turn) FILTER (WHERE role = 'assistant'), '')) AS loss_sha256,
 CAST(sum({len(chat.OPEN) + 1 + len(chat.CLOSE)} + length(role) + length({_ESCAPED.format(c='text')})) AS BIGINT) AS formatted_chars
FROM c GROUP BY conv_id"""

# Windows of 200 bytes by digest; those that begin at two places or more; runs of them; the bytes between the runs.
_REPEATS = """WITH b AS (SELECT row_number() OVER () AS row, doc_id, encode(coalesce(text, '')) AS data FROM documents),
n AS (SELECT *, octet_length(data) AS size FROM b),
w AS (SELECT row, i, md5(array_slice(data, i + 1, i + 200)) AS h FROM (SELECT row, data, unnest(range(0, size - 199)) AS i
  FROM n WHERE size >= 200) w0),
again AS (SELECT row, i FROM (SELECT *, count(*) OVER (PARTITION BY h) AS c FROM w) c0 WHERE c > 1),
steps AS (SELECT row, i, CASE WHEN i - lag(i) OVER (PARTITION BY row ORDER BY i) <= 200 THEN 0 ELSE 1 END AS fresh FROM again),
runs AS (SELECT row, i, sum(fresh) OVER (PARTITION BY row ORDER BY i) AS run FROM steps),
spans AS (SELECT row, min(i) AS a, max(i) + 200 AS e FROM runs GROUP BY row, run),
edges AS (SELECT row, CAST(0 AS BIGINT) AS a, CAST(0 AS BIGINT) AS e FROM n UNION ALL SELECT row, a, e FROM spans),
gaps AS (SELECT row, e AS s, lead(a) OVER (PARTITION BY row ORDER BY a, e) AS t FROM edges),
kept AS (SELECT g.row, sha256(unhex(string_agg(hex(array_slice(n.data, g.s + 1, coalesce(g.t, n.size))), '' ORDER BY g.s, g.t))) AS kept_sha256
  FROM gaps g JOIN n ON g.row = n.row GROUP BY g.row),
gone AS (SELECT row, CAST(sum(e - a) AS BIGINT) AS n_removed, count(*) AS n_spans FROM spans GROUP BY row)
SELECT doc_id, CAST(size AS BIGINT) AS n_bytes, coalesce(n_removed, 0) AS n_removed, coalesce(n_spans, 0) AS n_spans, kept_sha256
FROM n JOIN kept USING (row) LEFT JOIN gone USING (row)"""

_WHITE = r"\x20\x09-\x0D"
_DRAWS = ", ".join(f"CAST('0x' || substr(digest, {8 * k + 1}, 8) AS BIGINT) AS h{k + 1}" for k in range(4))
_CUT = f"""WITH t AS (SELECT doc_id, coalesce(text, '') AS text, sha256('42:' || coalesce(CAST(doc_id AS VARCHAR), '')) AS digest,
  regexp_extract_all(coalesce(text, ''), '[{_WHITE}]*[^{_WHITE}]+|[{_WHITE}]+') AS u FROM documents),
h AS (SELECT *, CAST(len(u) AS BIGINT) AS n, {_DRAWS} FROM t),
c AS (SELECT *, least(h1 % (n + 1), h2 % (n + 1)) AS a, greatest(h1 % (n + 1), h2 % (n + 1)) AS b,
  CASE WHEN text = '' OR contains(text, '<P>') OR contains(text, '<S>') OR contains(text, '<M>') OR h3 % 100 >= 50 THEN 'plain'
   WHEN h4 % 100 < 80 THEN 'spm' ELSE 'psm' END AS form FROM h),
p AS (SELECT *, array_to_string(list_slice(u, 1, a), '') AS pre, array_to_string(list_slice(u, a + 1, b), '') AS mid,
  array_to_string(list_slice(u, b + 1, n), '') AS suf FROM c)
SELECT doc_id, n, form, CASE WHEN form <> 'plain' THEN length(pre) END AS prefix_chars,
 CASE WHEN form <> 'plain' THEN length(mid) END AS middle_chars, sha256(CASE form WHEN 'plain' THEN text
  WHEN 'psm' THEN concat('<P>', pre, '<S>', suf, '<M>', mid) ELSE concat('<S>', suf, '<P>', pre, '<M>', mid) END) AS output_sha256,
 sha256(text) AS restored_sha256 FROM p"""

# Stretches of equal words at a distance, from pairs of equal strings of 16 words: a run has that many at least.
_PERIODS = f"""WITH crc AS (SELECT list_transform(range(0, 256), lambda i: list_reduce(list_prepend(i, range(0, 8)),
  lambda c, k: CASE WHEN c % 2 = 1 THEN xor(c >> 1, 3988292384) ELSE c >> 1 END)) AS t),
d AS (SELECT row_number() OVER () AS row, doc_id, regexp_extract_all(coalesce(text, ''), '[^{_WHITE}]+') AS w0,
  xor(list_reduce(list_prepend(CAST(4294967295 AS BIGINT), list_transform(string_split(CAST(doc_id AS VARCHAR), ''), lambda s: CAST(ascii(s) AS BIGINT))),
   lambda c, b: xor(c >> 8, t[(xor(c, b) & 255) + 1])), CAST(4294967295 AS BIGINT)) AS h FROM documents, crc),
n AS (SELECT *, CAST(len(w0) AS BIGINT) AS n, h // 10 AS g FROM d),
s AS (SELECT *, g % n AS a, 1 + (n - g % n) // (3 + g % 8) AS p FROM n WHERE n > 0),
x AS (SELECT row, i, w0[CASE WHEN h % 10 = 0 AND i >= a THEN a + (i - a) % p ELSE i END + 1] AS x
  FROM (SELECT row, w0, h, a, p, unnest(range(0, n)) AS i FROM s) s0),
w AS (SELECT row, list(x ORDER BY i) AS w FROM x GROUP BY row),
g AS (SELECT row, i, md5(array_to_string(list_slice(w, i + 1, i + 16), ' ')) AS g FROM (SELECT row, w, unnest(range(0, len(w) - 15)) AS i
  FROM w WHERE len(w) >= 24) w0),
q AS (SELECT a.row, a.i, b.i - a.i AS q FROM g a JOIN g b ON a.row = b.row AND a.g = b.g AND a.i < b.i),
e AS (SELECT row, q, i, i - row_number() OVER (PARTITION BY row, q ORDER BY i) AS span FROM q),
f AS (SELECT row, q, min(i) AS start, count(*) + 15 + q AS length FROM e GROUP BY row, q, span),
r AS (SELECT row, start, length, min(q) AS period FROM f WHERE length >= greatest(24, 3 * q) GROUP BY row, start, length),
k AS (SELECT *, row_number() OVER (PARTITION BY row ORDER BY CAST(length AS DOUBLE) / period DESC, start, period) AS rank FROM r),
o AS (SELECT row, count(*) AS n_runs, string_agg(concat(start, ',', length, ',', period, chr(10)), '' ORDER BY start, period) AS listed FROM r GROUP BY row),
z AS (SELECT DISTINCT row, unnest(range(start + period, start + length)) AS i FROM r),
l AS (SELECT x.row, string_agg(x.x, ' ' ORDER BY x.i) AS left_over FROM x LEFT JOIN z ON x.row = z.row AND x.i = z.i WHERE z.i IS NULL GROUP BY x.row)
SELECT d.doc_id, coalesce(o.n_runs, 0) AS n_runs, k.start, k.length, k.period, 1000 * k.length // k.period AS exponent_milli,
 sha256(coalesce(o.listed, '')) AS runs_sha256, sha256(coalesce(l.left_over, '')) AS collapsed_sha256
FROM d LEFT JOIN o ON d.row = o.row LEFT JOIN k ON d.row = k.row AND k.rank = 1 LEFT JOIN l ON d.row = l.row"""

ORACLE: dict[str, str] = {"op1_decontaminate": _DECONTAMINATE, "op3_warc": _ARCHIVE, "op8_chat": _CHAT, "op10_repeats": _REPEATS,
                          "op12_middle": _CUT, "op13_periods": _PERIODS}
