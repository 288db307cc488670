"""DuckDB SQL of the queries that SQL can express."""

from __future__ import annotations

from tidewater.llm import mixing, pii, quality_rules, warc

_WORD = r"[^\x20\x09-\x0D]+"

_CONFIRM = {
    "email": "true",
    "ip": "len(list_filter(string_split(value, '.'), lambda p: length(ltrim(p, '0')) > 3"
          " or coalesce(try_cast(ltrim(p, '0') as integer), 0) > 255)) = 0",
    "card": "length(digits) between 16 and 19 and (select sum(case when (length(digits) - i) % 2 = 0 then d"
            " when d > 4 then 2 * d - 9 else 2 * d end) from (select i, cast(substr(digits, i, 1) as integer) as d"
            " from (select unnest(range(1, length(digits) + 1)) as i))) % 10 = 0",
    "phone": "length(digits) between 8 and 15",
    "iban": "length(replace(value, ' ', '')) between 15 and 34 and list_reduce(list_prepend(0, list_transform("
            "string_split(substr(replace(value, ' ', ''), 5) || substr(replace(value, ' ', ''), 1, 4), ''),"
            " lambda c: case when ascii(c) >= 65 then ascii(c) + 945 else ascii(c) - 48 end)),"
            " lambda a, b: case when b >= 1000 then (a * 100 + b - 1000) % 97 else (a * 10 + b) % 97 end) = 1",
    "local_phone": "true",
}


def _kind_sql(n: int, kind: pii.Kind) -> str:
    both = f"(?s)(.*?)({kind.sql_pattern})"
    return f"""
    select doc_id, {n} as place, '{kind.name}' as kind, start, stop, value, digits,
           {kind.prior} + case when regexp_matches(right(gap, {pii.CONTEXT_CHARS}),
               '(?i)(?:^|[^A-Za-z])(?:{kind.context})(?:[^A-Za-z]|$)') then {pii.CONTEXT_BONUS} else 0 end as score
    from (select *, stop - length(value) as start, regexp_replace(value, '[^0-9]', '', 'g') as digits
          from (select doc_id, gap, value,
                       sum(length(gap) + length(value)) over (partition by doc_id order by i) as stop
                from (select doc_id, unnest(regexp_extract_all(text, '{both}', 1)) as gap,
                             unnest(regexp_extract_all(text, '{both}', 2)) as value,
                             generate_subscripts(regexp_extract_all(text, '{both}', 1), 1) as i
                      from (select doc_id, coalesce(text, '') as text from documents))))
    where {_CONFIRM[kind.name]}"""


def _pii() -> str:
    spans = " union all ".join(_kind_sql(n, k) for n, k in enumerate(pii.KINDS))
    counts = ", ".join(f"count(*) filter (where kind = '{k.name}') as n_{k.name}" for k in pii.KINDS)
    base = ", ".join(f"'{k}'" for k in pii.BASE_KINDS)
    span = "kind || ':' || start || ':' || stop"
    return f"""
    with spans as (select * from ({spans}) where score >= {pii.MIN_SCORE}),
    per as (select doc_id, {counts},
                   string_agg({span}, ',' order by place, start) filter (where kind in ({base})) as base,
                   string_agg({span}, ',' order by place, start) as spans, max(score) as max_score
            from spans group by doc_id)
    select d.doc_id, {', '.join(f'coalesce(n_{k.name}, 0) as n_{k.name}' for k in pii.KINDS)},
           sha256(coalesce(base, '')) as base_sha256, coalesce(spans, '') as spans,
           coalesce(max_score, 0) as max_score
    from documents d left join per on d.doc_id = per.doc_id"""


def _mixing() -> str:
    weights = "[" + ", ".join(map(str, mixing.WEIGHTS)) + "]"
    most = mixing.MAX_EPOCHS
    # The rate at which all is shared: sources are at their limits in the order
    # of limit by weight; the first prefix of them that leaves the next one
    # under its limit is right.
    return f"""
    with sized as (select doc_id, source, len(regexp_extract_all(coalesce(text, ''), '{_WORD}')) as size,
                          md5('0:' || coalesce(cast(doc_id as varchar), 'null')) as key from documents),
    per as (select *, ({weights})[cast((row_number() over (order by source nulls last) - 1) % {len(mixing.WEIGHTS)} + 1 as bigint)] as weight
            from (select source, cast(sum(size) as bigint) as source_size from sized group by source)),
    ordered as (select *, coalesce(sum({most} * source_size) over w, 0) as capped, coalesce(sum(weight) over w, 0) as gone,
                       sum(source_size) over () as total, sum(weight) over () as weights
                from per window w as (order by {most} * source_size / weight, source nulls last
                                      rows between unbounded preceding and 1 preceding)),
    rate as (select (total - capped) as num, (weights - gone) as den from ordered
             where weight * (total - capped) <= {most} * source_size * (weights - gone)
             order by {most} * source_size / weight limit 1),
    targets as (select source, source_size,
                       case when cast(weight as hugeint) * num > cast({most} * source_size as hugeint) * den
                            then cast({most} * source_size as double)
                            else cast(weight as double) * cast(num as double) / cast(den as double) end as target
                from per, rate),
    budgets as (select *, cast(floor(target) as bigint) as budget,
                       case when source_size > 0 then cast(floor(target) as bigint) // source_size else 0 end as epochs
                from targets),
    placed as (select s.*, b.source_size, b.target, b.epochs, b.budget - b.epochs * b.source_size as part,
                      coalesce(sum(size) over (partition by s.source order by key
                                               rows between unbounded preceding and 1 preceding), 0) as before
               from sized s join budgets b on s.source is not distinct from b.source)
    select doc_id, cast(size as bigint) as size, source_size, target, source,
           cast(epochs * size + case when before >= part then 0 when before + size < part then size
                                     else part - before end as bigint) as taken
    from placed"""


def _quality_rules() -> str:
    r = quality_rules
    low, high = r.MEAN_WORD_CHARS
    return f"""
    with words as (select doc_id, source, coalesce(text, '') as text,
                          regexp_extract_all(coalesce(text, ''), '{_WORD}') as words from documents),
    windows as (select doc_id, i, array_to_string(words[i:i + {r.WINDOW - 1}], ' ') as w
                from (select doc_id, words, unnest(range(1, len(words) - {r.WINDOW - 2})) as i from words)),
    twice as (select doc_id, i from (select *, count(*) over (partition by doc_id, w) as n from windows) where n > 1),
    repeats as (select doc_id, sum(least({r.WINDOW}, i - last)) as n_repeat_words
                from (select doc_id, i, lag(i, 1, -{r.WINDOW}) over (partition by doc_id order by i) as last from twice)
                group by doc_id),
    lines as (select doc_id, count(*) as n_lines, count(*) - count(distinct line) as n_dup_lines
              from (select doc_id, unnest(string_split(text, chr(10))) as line from words)
              where regexp_matches(line, '{_WORD}') group by doc_id),
    counted as (select w.doc_id, w.source, len(words) as n_words,
                       length(regexp_replace(text, '[\\x20\\x09-\\x0D]', '', 'g')) as word_chars,
                       length(regexp_replace(text, '[^{r.SYMBOLS}]', '', 'g')) as n_symbols,
                       coalesce(n_dup_lines, 0) as n_dup_lines, coalesce(n_lines, 0) as n_lines,
                       cast(coalesce(n_repeat_words, 0) as bigint) as n_repeat_words
                from words w left join repeats using (doc_id) left join lines using (doc_id)),
    based as (select *, n_words < {r.MIN_WORDS} or n_repeat_words * 100 > n_words * {r.MAX_REPEAT_PERCENT} as base_failed
              from counted),
    failed as (select *, base_failed or n_symbols * 100 > n_words * {r.MAX_SYMBOLS_PERCENT}
                      or n_dup_lines * 100 > n_lines * {r.MAX_DUP_LINE_PERCENT}
                      or word_chars < n_words * {low} or word_chars > n_words * {high} as failed from based),
    hosts as (select source, count(*) as n, count(*) filter (where failed) as f from failed group by source),
    moments as (select least(greatest(avg(f / n), 1e-6), 1 - 1e-6) as m, coalesce(var_samp(f / n), 0) as v, avg(1.0 / n) as inv
                from hosts),
    prior as (select m, least(greatest(case when v - m * (1 - m) * inv > 0 then m * (1 - m) / (v - m * (1 - m) * inv) - 1
                                            else {r.PRIOR_WEIGHT} end, 2), 1e4) as k from moments),
    verdicts as (select source, (f + m * k) / (n + k) > {r.HOST_LIMIT} as rejected from hosts, prior)
    select doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, base_failed,
           not base_failed and not rejected as kept
    from failed f join verdicts v on f.source is not distinct from v.source"""


def _warc() -> str:
    return f"""
    with p as (select page_id, octet_length(encode(coalesce(html, ''))) as payload_bytes,
                      sha256(coalesce(html, '')) as payload_digest from pages),
    f as (select payload_digest, min(page_id) as first_id from p where payload_bytes >= {warc.MIN_REVISIT_BYTES}
          group by payload_digest)
    select page_id, payload_bytes, p.payload_digest,
           case when page_id > first_id then 'revisit' else 'response' end as record_type,
           case when page_id > first_id then first_id end as refers_to
    from p left join f on p.payload_digest = f.payload_digest"""


def _ngram_join(k: int = 3, percent: int = 90) -> str:
    return f"""
    with recursive w as (select doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ',
                                               'abcdefghijklmnopqrstuvwxyz'), '{_WORD}') as words from documents),
    s as materialized (select distinct doc_id, array_to_string(words[i:i + {k - 1}], ' ') as token
          from (select doc_id, words, unnest(range(1, greatest(len(words) - {k - 2}, 2))) as i from w where len(words) > 0)),
    n as materialized (select doc_id, count(*) as n from s group by doc_id),
    links as materialized (
        select a, b from (select x.doc_id as a, y.doc_id as b, count(*) as n_both
                          from s x join s y on x.token = y.token and x.doc_id <> y.doc_id group by x.doc_id, y.doc_id)
        join n na on na.doc_id = a join n nb on nb.doc_id = b where 100 * n_both >= {percent} * (na.n + nb.n - n_both)),
    reach(a, b) as (select doc_id, doc_id from documents union select r.a, l.b from reach r join links l on r.b = l.a)
    select d.doc_id, coalesce(n.n, 0) as n_shingles, r.component_id
    from documents d left join n on n.doc_id = d.doc_id
         join (select a, min(b) as component_id from reach group by a) r on r.a = d.doc_id"""


def _decontamination(k: int = 5, percent: int = 80) -> str:
    def shingles(table: str, ident: str, size: str) -> str:
        return f"""select distinct {ident}, width, array_to_string(words[i:i + width - 1], ' ') as token
            from (select {ident}, words, width, unnest(range(1, greatest(len(words) - width + 2, 1))) as i
                  from (select {ident}, regexp_extract_all(lower(text), '[\\p{{L}}\\p{{N}}]+') as words from {table}), {size})"""
    return f"""
    with item_words as (select item_id, len(regexp_extract_all(lower(text), '[\\p{{L}}\\p{{N}}]+')) as n from benchmark),
    widths as (select distinct least({k}, n) as width from item_words where n > 0),
    items as (select s.* from ({shingles('benchmark', 'item_id', 'widths')}) s
              join item_words w on w.item_id = s.item_id and s.width = least({k}, w.n)),
    docs as ({shingles('documents', 'doc_id', 'widths')}),
    sizes as (select item_id, count(*) as item_shingles from items group by item_id)
    select doc_id, h.item_id, item_shingles, shared_shingles
    from (select d.doc_id, i.item_id, count(*) as shared_shingles
          from docs d join items i on d.token = i.token and d.width = i.width group by d.doc_id, i.item_id) h
    join sizes z on z.item_id = h.item_id where shared_shingles * 100 >= {percent} * item_shingles"""


PII, MIXING, QUALITY_RULES, WARC = _pii(), _mixing(), _quality_rules(), _warc()
NGRAM_JOIN, DECONTAMINATION = _ngram_join(), _decontamination()

# CRC-32 with its usual reversed polynomial (fixed value), a byte at a time.
_CRC_TABLE = """
crc_table AS (
  SELECT list_transform(range(256), lambda i: list_reduce(list_prepend(i::UBIGINT, [0, 0, 0, 0, 0, 0, 0, 0]::UBIGINT[]),
    lambda c, z: CASE WHEN c % 2 = 1 THEN xor(c >> 1, 3988292384::UBIGINT) ELSE c >> 1 END)) AS tab
)"""


def _crc(codes: str) -> str:
    """CRC-32 of a list of byte values, with crc_table in scope."""
    return (f"xor(list_reduce(list_prepend(4294967295::UBIGINT, ({codes})::UBIGINT[]), "
            "lambda c, b: xor(c >> 8, tab[(xor(c, b) % 256 + 1)::INTEGER])), 4294967295::UBIGINT)")


# Runs hold ASCII letters and U+00C0 to U+00FF, which are two bytes of UTF-8 each.
_RUN_BYTES = "flatten(list_transform(string_split(key, ''), lambda x: CASE WHEN ord(x) < 128 THEN [ord(x)] ELSE [195, ord(x) - 64] END))"

SPELLING = f"""
WITH RECURSIVE {_CRC_TABLE},
runs AS (
  SELECT doc_id, translate(run, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS run, count(*) AS n
  FROM (SELECT doc_id, unnest(regexp_extract_all(text, '[A-Za-z\\x{{00C0}}-\\x{{00FF}}]+')) AS run FROM documents)
  GROUP BY ALL
),
hashed AS (
  SELECT run, n, {_crc(_RUN_BYTES)} AS h
  FROM (SELECT run, n, coalesce(doc_id::VARCHAR, '') || ':' || run AS key FROM runs WHERE length(run) >= 7), crc_table
),
spelt AS (
  SELECT CASE WHEN h % 31 = 0 THEN left(run, (h % length(run))::INTEGER) || substr(run, (h % length(run))::INTEGER + 2) ELSE run END AS word, n
  FROM hashed
),
vocabulary AS (
  SELECT word, sum(n)::BIGINT AS n FROM spelt WHERE length(word) >= 7 GROUP BY word HAVING sum(n) >= 2
),
places AS (SELECT word, unnest(range(length(word))) AS i FROM vocabulary),
cut AS (SELECT word, left(word, i::INTEGER) AS a, substr(word, i::INTEGER + 2) AS b FROM places),
near AS (
  SELECT x.word, y.word AS other FROM cut x JOIN cut y ON x.a = y.a AND x.b = y.b AND x.word <> y.word
  UNION SELECT c.word, v.word FROM cut c JOIN vocabulary v ON v.word = c.a || c.b
  UNION SELECT v.word, c.word FROM cut c JOIN vocabulary v ON v.word = c.a || c.b
),
best AS (
  SELECT near.word, count(*) AS n_near, min({{'minus_n': -v.n, 'word': near.other}}) AS top
  FROM near JOIN vocabulary v ON v.word = near.other GROUP BY near.word
),
formed AS (
  SELECT v.word, v.n, coalesce(b.n_near, 0) AS n_near,
    CASE WHEN -b.top.minus_n >= 10 * v.n THEN b.top.word END AS form, CASE WHEN -b.top.minus_n >= 10 * v.n THEN -b.top.minus_n END AS form_n
  FROM vocabulary v LEFT JOIN best b USING (word)
),
chain AS (
  SELECT word, word AS at FROM formed
  UNION ALL SELECT chain.word, formed.form FROM chain JOIN formed ON formed.word = chain.at WHERE formed.form IS NOT NULL
)
SELECT f.word, f.form, c.at AS root, f.n, f.n_near::BIGINT AS n_near, f.form_n::BIGINT AS form_n
FROM formed f JOIN chain c ON c.word = f.word JOIN formed l ON l.word = c.at AND l.form IS NULL
"""

PREFIX_TRIE = f"""
WITH {_CRC_TABLE},
own AS (
  SELECT conv_id, coalesce(role, '') AS role, coalesce(text, '') AS text,
    row_number() OVER (PARTITION BY conv_id ORDER BY turn NULLS FIRST, coalesce(role, ''), sha256(coalesce(text, ''))) - 1 AS pos
  FROM conversations WHERE conv_id IS NOT NULL
),
convs AS (
  SELECT conv_id, {_crc("list_transform(string_split(conv_id::VARCHAR, ''), lambda x: ord(x))")} % 4 AS h
  FROM (SELECT DISTINCT conv_id FROM own), crc_table
),
heads AS (
  SELECT c.conv_id, o.role, o.text, o.pos FROM convs c JOIN own o ON o.conv_id = c.conv_id - c.conv_id % 20 AND o.pos < c.h
),
lengths AS (SELECT c.conv_id, c.h, count(h.pos) AS k FROM convs c LEFT JOIN heads h USING (conv_id) GROUP BY ALL),
turns AS (
  SELECT * FROM heads
  UNION ALL SELECT conv_id, role, text, pos - h + k FROM own JOIN lengths USING (conv_id) WHERE pos >= h
),
paths AS (
  SELECT conv_id, 0 AS depth, '' AS path, 0 AS words FROM convs
  UNION ALL
  SELECT conv_id, pos + 1, sha256(string_agg(sha256(role) || sha256(text), '') OVER (PARTITION BY conv_id ORDER BY pos)),
    len(regexp_extract_all(text, '[^\\x20\\x09-\\x0D]+'))
  FROM turns
),
lasts AS (SELECT conv_id, max(depth) AS depth FROM paths GROUP BY conv_id),
nodes AS (
  SELECT path, depth, min(conv_id) AS conv_id, count(*) AS n_convs, any_value(words) AS words,
    sha256(coalesce(string_agg(conv_id::VARCHAR, ',' ORDER BY conv_id) FILTER (WHERE depth = last), '')) AS ends_sha256
  FROM (SELECT p.*, l.depth AS last FROM paths p JOIN lasts l USING (conv_id)) GROUP BY path, depth
),
up AS (
  SELECT n.path, n.depth, p.path AS above, p.depth AS above_depth
  FROM nodes n JOIN paths p ON p.conv_id = n.conv_id AND p.depth <= n.depth
),
kids AS (SELECT above AS path, above_depth AS depth, count(*) AS n_children FROM up WHERE above_depth = depth - 1 GROUP BY ALL),
sums AS (
  SELECT u.above AS path, u.above_depth AS depth, count(*) FILTER (WHERE k.path IS NULL) AS n_leaves, sum((n.n_convs - 1) * n.words) AS saved
  FROM up u JOIN nodes n USING (path, depth) LEFT JOIN kids k USING (path, depth) GROUP BY ALL
)
SELECT n.conv_id::BIGINT AS conv_id, n.depth::BIGINT AS depth, p.conv_id::BIGINT AS parent_conv_id, n.n_convs::BIGINT AS n_convs,
  coalesce(k.n_children, 0)::BIGINT AS n_children, s.n_leaves::BIGINT AS n_leaves, s.saved::BIGINT AS saved_tokens, n.ends_sha256
FROM nodes n JOIN sums s USING (path, depth) LEFT JOIN kids k USING (path, depth)
  LEFT JOIN up u ON u.path = n.path AND u.depth = n.depth AND u.above_depth = n.depth - 1
  LEFT JOIN nodes p ON p.path = u.above AND p.depth = u.above_depth
"""
