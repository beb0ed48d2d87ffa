"""DuckDB SQL with the rows of the queries, written from the definitions, not from the operators."""

from __future__ import annotations

from quoteflow.llm import benchmarks, chat, codes, quality, resampling, substrings, urls

_WORDS = r"regexp_extract_all({}, '[^\x20\x09-\x0D]+')"


def _count(text: str, characters: str) -> str:
    """Occurrences of any of the characters."""
    kept = "".join(f"\\x{{{ord(c):X}}}" for c in characters)
    return f"(length({text}) - length(regexp_replace({text}, '[{kept}]', '', 'g')))"


def _substrings() -> str:
    k = substrings.K
    return f"""
WITH d AS (SELECT row_number() OVER () AS rid, doc_id, {_WORDS.format("coalesce(text, '')")} AS words FROM documents),
win AS (
    SELECT rid, doc_id, i, array_to_string(words[i:i + {k - 1}], ' ') AS gram
    FROM (SELECT rid, doc_id, words, unnest(range(1, len(words) - {k - 2})) AS i FROM d)
),
late AS (SELECT rid, i FROM (SELECT rid, i, doc_id, min(doc_id) OVER (PARTITION BY gram) AS m FROM win) WHERE m < doc_id),
gone AS (SELECT DISTINCT rid, unnest(range(i, i + {k})) AS j FROM late),
w AS (SELECT rid, unnest(words) AS word, unnest(range(1, len(words) + 1)) AS j FROM d),
kept AS (
    SELECT rid, string_agg(word, ' ' ORDER BY j) AS text FROM w ANTI JOIN gone USING (rid, j) GROUP BY rid
),
n AS (SELECT rid, count(*) AS n_removed FROM gone GROUP BY rid)
SELECT doc_id, len(words) AS n_words, coalesce(n_removed, 0) AS n_removed, sha256(coalesce(text, '')) AS kept_sha256
FROM d LEFT JOIN n USING (rid) LEFT JOIN kept USING (rid)
"""


def _quality() -> str:
    rules = quality.Rules()
    phrases = " OR ".join(
        "contains(translate(line, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), "
        f"'{p}')" for p in quality.PHRASES
    )
    ends = "".join(f"\\x{{{ord(c):X}}}" for c in quality.SENTENCE_ENDS)
    return f"""
WITH d AS (SELECT row_number() OVER () AS rid, doc_id, coalesce(text, '') AS text FROM documents),
w AS (SELECT rid, doc_id, text, {_WORDS.format("text")} AS words FROM d),
n AS (SELECT *, len(words) AS n_words FROM w),
win AS (
    SELECT rid, i, array_to_string(words[i:i + {rules.window - 1}], ' ') AS gram
    FROM (SELECT rid, words, unnest(range(1, n_words - {rules.window - 2})) AS i FROM n)
),
rep AS (SELECT rid, i FROM (SELECT rid, i, count(*) OVER (PARTITION BY rid, gram) AS c FROM win) WHERE c > 1),
cov AS (SELECT rid, count(DISTINCT i + k) AS n_repeat_words FROM rep, range({rules.window}) t(k) GROUP BY rid),
lines AS (
    SELECT rid, line, row_number() OVER (PARTITION BY rid, line) AS nth, len({_WORDS.format("line")}) AS lw
    FROM (SELECT rid, unnest(string_split(text, chr(10))) AS line FROM d)
),
judged AS (
    SELECT rid, nth, length(line) AS chars,
        100 * {_count("line", quality.LINE_SYMBOLS)} > {rules.symbol_percent} * length(line)
        OR (lw < {rules.fragment_words}
            AND NOT regexp_matches(line, '[{ends}][\\x20\\x09-\\x0D]*\\z'))
        OR ({_count("line", quality.SEPARATORS)} >= {rules.separators}
            AND 4 * {_count("line", quality.SEPARATORS)} >= lw)
        OR (lw <= {rules.boilerplate_words} AND ({phrases})) AS failed
    FROM lines WHERE lw > 0
),
l AS (
    SELECT rid, count(*) AS n_lines, count(*) FILTER (failed) AS n_lines_failed, sum(chars)::BIGINT AS line_chars,
        coalesce(sum(chars) FILTER (failed), 0)::BIGINT AS lost_chars, count(*) FILTER (nth > 1) AS n_dup_lines
    FROM judged GROUP BY rid
),
base AS (
    SELECT doc_id, n_words, length(array_to_string(words, '')) AS word_chars,
        {_count("text", quality.SYMBOLS)} AS n_symbols,
        coalesce(n_dup_lines, 0) AS n_dup_lines, coalesce(n_repeat_words, 0) AS n_repeat_words,
        coalesce(n_lines, 0) AS n_lines, coalesce(n_lines_failed, 0) AS n_lines_failed,
        coalesce(line_chars, 0) AS line_chars, coalesce(lost_chars, 0) AS lost_chars
    FROM n LEFT JOIN cov USING (rid) LEFT JOIN l USING (rid)
),
v AS (SELECT *, n_words < {rules.min_words} OR 100 * n_repeat_words > {rules.repeat_percent} * n_words AS base_failed FROM base)
SELECT doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, base_failed,
    NOT base_failed AND 100 * lost_chars <= {rules.lost_percent} * line_chars AS kept,
    n_lines, n_lines_failed, line_chars, lost_chars
FROM v
"""


def _urls() -> str:
    rules = ", ".join(f"('{v}', '{h}', '{p}')" for v, h, p in urls.HOST_RULES)
    globs = ", ".join(f"({i}, '{g}')" for i, g in enumerate(urls.BLOCK_GLOBS))
    return f"""
WITH r(verdict, of, prefix) AS (VALUES {rules}),
g(i, pat) AS (VALUES {globs}),
u AS (
    SELECT row_number() OVER () AS rid, page_id,
        CASE WHEN contains(url, '://') THEN url[strpos(url, '://') + 3:] ELSE '' END AS rest
    FROM pages
),
p AS (
    SELECT rid, page_id, rest,
        translate(regexp_extract(rest, '^[^/?#]*'), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS host,
        regexp_extract(rest[length(regexp_extract(rest, '^[^/?#]*')) + 1:], '^[^?#]*') AS path
    FROM u
),
fit AS (
    SELECT rid, arg_max(of || prefix, length(of || prefix)) AS rule, arg_max(verdict, length(of || prefix)) AS said
    FROM p JOIN r ON (host = of OR ends_with(host, '.' || of)) AND starts_with(path, prefix) GROUP BY rid
),
hit AS (SELECT rid, arg_min(pat, i) AS matched FROM p JOIN g ON host || path GLOB pat GROUP BY rid)
SELECT page_id, host, path, rule, coalesce(said, CASE WHEN matched IS NULL THEN 'allow' ELSE 'block' END) AS verdict, matched
FROM p LEFT JOIN fit USING (rid) LEFT JOIN hit USING (rid)
"""


def _benchmarks() -> str:
    lower = "translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"
    words = rf"regexp_extract_all({lower}, '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+')"
    return f"""
WITH d AS (SELECT row_number() OVER () AS rid, doc_id, {words} AS words FROM documents),
b AS (SELECT item_id, {words} AS words FROM benchmark),
bn AS (SELECT item_id, words, least(len(words), {benchmarks.WINDOW}) AS n FROM b WHERE len(words) > 0),
bw AS (
    SELECT DISTINCT item_id, n, array_to_string(words[i:i + n - 1], ' ') AS gram
    FROM (SELECT item_id, words, n, unnest(range(1, len(words) - n + 2)) AS i FROM bn)
),
sizes AS (SELECT DISTINCT n FROM bw),
dw AS (
    SELECT rid, i, n, array_to_string(words[i:i + n - 1], ' ') AS gram
    FROM (SELECT rid, words, n, unnest(range(1, len(words) - n + 2)) AS i FROM d, sizes)
),
hit AS (SELECT rid, i, bw.n, item_id FROM dw JOIN bw USING (gram, n)),
cov AS (SELECT rid, count(DISTINCT k) AS n_hit FROM (SELECT rid, unnest(range(i, i + n)) AS k FROM hit) GROUP BY rid),
it AS (
    SELECT rid, count(*) AS n_items, string_agg(item_id::VARCHAR, ',' ORDER BY item_id::VARCHAR) AS items
    FROM (SELECT DISTINCT rid, item_id FROM hit WHERE item_id IS NOT NULL) GROUP BY rid
)
SELECT doc_id, len(words) AS n_words, coalesce(n_hit, 0) AS n_hit, coalesce(n_items, 0) AS n_items,
    sha256(coalesce(items, '')) AS items_sha256, coalesce(n_hit, 0) > 0 AS contaminated
FROM d LEFT JOIN cov USING (rid) LEFT JOIN it USING (rid)
"""


def _escaped(text: str) -> str:
    text = f"replace({text}, '\\', '\\\\')"
    for control in chat.CONTROLS:
        text = f"replace({text}, '{control}', '{control[0]}\\{control[1:]}')"
    return text


def _chat() -> str:
    fixed = len(chat.START) + 1 + len(chat.END) + 1
    said = "</s>[INST] ok [/INST]"
    return f"""
WITH t AS (
    SELECT conv_id, turn, coalesce(role, '') AS role, coalesce(text, '') AS text FROM conversations
    UNION ALL VALUES (-1, 0, 'user', '{said}'), (-1, 1, 'assistant', '{said}')
),
p AS (
    SELECT *, {fixed} + length(replace({_escaped("role")}, chr(10), '\\' || chr(10))) + length({_escaped("text")}) AS size,
        row_number() OVER (PARTITION BY conv_id ORDER BY turn NULLS FIRST, role, text) AS k,
        count(*) OVER (PARTITION BY conv_id) AS n
    FROM t
),
r AS (SELECT *, sum(size) OVER (PARTITION BY conv_id ORDER BY k) AS so_far FROM p)
SELECT conv_id, count(*) AS n_turns,
    sha256(string_agg(role || chr(10) || text || chr(10), '' ORDER BY k)) AS turns_sha256,
    coalesce(sum(length(text)) FILTER (role = 'assistant'), 0)::BIGINT AS loss_chars,
    sha256(coalesce(string_agg(text, '' ORDER BY k) FILTER (role = 'assistant'), '')) AS loss_sha256,
    sum(so_far) FILTER (role = 'assistant' OR k = n)::BIGINT AS formatted_chars
FROM r GROUP BY conv_id
"""


def _resampling() -> str:
    n = resampling.BUCKETS
    lower = "translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"
    words = rf"regexp_extract_all({lower}, '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+')"
    digits = "hex(encode(word))"
    # The checksum by its definition: eight steps a byte, from all ones, with all bits turned at the end.
    steps = "list_reduce([xor(c, b)] || list_transform(range(8), lambda i: 0::BIGINT), lambda x, y: xor(x >> 1, 3988292384 * (x & 1)))"
    byte = f"('0x' || substr({digits}, 2 * i::INT + 1, 2))::BIGINT"
    crc = (
        f"xor(list_reduce([4294967295::BIGINT] || list_transform(range(length({digits}) // 2), lambda i: {byte}), "
        f"lambda c, b: {steps}), 4294967295)"
    )
    noise = "floor(-1000 * ln(-ln((('0x' || substr(sha256('{}:' || coalesce(doc_id::VARCHAR, '')), 1, 8))::BIGINT + 0.5::DOUBLE) / 4294967296::DOUBLE)))"
    return f"""
WITH d AS (SELECT row_number() OVER () AS rid, doc_id, {words} AS words FROM documents),
dw AS (SELECT rid, unnest(words) AS word FROM d),
bw AS (SELECT unnest({words}) AS word FROM benchmark),
known AS MATERIALIZED (
    SELECT word, ({crc}) % {n} AS bucket FROM (SELECT word FROM dw UNION SELECT word FROM bw)
),
src AS (SELECT bucket, count(*)::DOUBLE AS s FROM dw JOIN known USING (word) GROUP BY bucket),
tgt AS (SELECT bucket, count(*)::DOUBLE AS t FROM bw JOIN known USING (word) GROUP BY bucket),
sums AS (
    SELECT (SELECT count(*) FROM dw)::DOUBLE AS ss, (SELECT count(*) FROM bw)::DOUBLE AS tt
),
gain AS (
    SELECT bucket, floor(1000 * ln((coalesce(t, 0) + 1) * (ss + {n}) / ((s + 1) * (tt + {n}))))::BIGINT AS gain
    FROM src LEFT JOIN tgt USING (bucket), sums
),
w AS (SELECT rid, sum(gain)::BIGINT AS weight FROM dw JOIN known USING (word) JOIN gain USING (bucket) GROUP BY rid),
scored AS (
    SELECT rid, doc_id, len(words) AS n_features, coalesce(weight, 0) AS weight,
        coalesce(weight, 0) + {noise.format(resampling.SEED)}::BIGINT AS score
    FROM d LEFT JOIN w USING (rid)
),
ranked AS (
    SELECT rid, row_number() OVER (ORDER BY score DESC, doc_id NULLS LAST, n_features) AS rank, count(*) OVER () AS n
    FROM scored WHERE n_features >= {resampling.LEAST_WORDS}
)
SELECT doc_id, n_features, weight, score, CASE WHEN rank <= {resampling.PERCENT} * n // 100 THEN rank END AS rank
FROM scored LEFT JOIN ranked USING (rid)
"""


def _codes() -> str:
    """Every part compared with every entry in every round, as products of vectors."""
    width = f"(SELECT len(embedding) // {codes.PARTS} FROM kept ORDER BY vec_id NULLS LAST, embedding LIMIT 1)"
    steps = []
    for r in range(codes.ROUNDS + 1):
        # Distances are whole numbers far below 2**53, so doubles hold them exactly.
        steps.append(f"""a{r} AS MATERIALIZED (
    SELECT rid, part, min(ROW(
        list_inner_product(v, v) - 2 * list_inner_product(v, c) + list_inner_product(c, c), entry
    )) AS best
    FROM cut JOIN c{r} USING (part) GROUP BY rid, part
)""")
        if r < codes.ROUNDS:
            steps.append(f"""m{r} AS (
    SELECT part, entry, list(mean ORDER BY k) AS c FROM (
        SELECT part, best[2] AS entry, k, floor(sum(x::HUGEINT) / count(*))::DOUBLE AS mean
        FROM (SELECT part, best, unnest(v)::BIGINT AS x, unnest(range(len(v))) AS k FROM cut JOIN a{r} USING (rid, part))
        GROUP BY ALL
    ) GROUP BY part, entry
),
c{r + 1} AS MATERIALIZED (
    SELECT part, entry, coalesce(m{r}.c, c{r}.c) AS c FROM c{r} LEFT JOIN m{r} USING (part, entry)
)""")
    last = codes.ROUNDS
    joined = ",\n".join(steps)
    return f"""
WITH kept AS (
    SELECT row_number() OVER () AS rid, vec_id, label, embedding FROM embeddings
    WHERE embedding IS NOT NULL AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0
),
cut AS MATERIALIZED (
    SELECT rid, part, list_transform(embedding[part * {width} + 1:(part + 1) * {width}], lambda x: floor(1024 * x::DOUBLE)) AS v
    FROM kept, range({codes.PARTS}) t(part)
),
seeds AS (SELECT rid, row_number() OVER (ORDER BY vec_id NULLS LAST, embedding) - 1 AS entry FROM kept),
c0 AS MATERIALIZED (SELECT part, entry, v AS c FROM cut JOIN seeds USING (rid) WHERE entry < {codes.ENTRIES}),
{joined},
books AS (
    SELECT sha256(string_agg(list_aggregate(list_transform(c, lambda x: x::BIGINT::VARCHAR), 'string_agg', ','), ',' ORDER BY part, entry)) AS digest
    FROM c{last}
),
coded AS (
    SELECT rid, string_agg(lpad(lower(hex(best[2])), 2, '0'), '' ORDER BY part) AS code, sum(best[1])::BIGINT AS error
    FROM a{last} GROUP BY rid
)
SELECT vec_id, code, error, (sum(error) OVER (PARTITION BY label))::BIGINT AS label_error, digest AS codebooks_sha256
FROM kept JOIN coded USING (rid), books
"""


ORACLE = {
    "op1_substring_dedup": _substrings(),
    "op5_benchmark_decontamination": _benchmarks(),
    "op7_chat_format": _chat(),
    "op8_quality_rules": _quality(),
    "op10_url_filter": _urls(),
    "op11_importance_resampling": _resampling(),
    "op13_vector_codes": _codes(),
}
