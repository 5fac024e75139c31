"""DuckDB SQL for the queries that SQL can express, from their definitions and not from the code."""

from __future__ import annotations

UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
WORDS = r"'[^\x20\x09-\x0D]+'"

OP7 = rf"""
WITH RECURSIVE w AS (
    SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), '{UPPER}', '{LOWER}'), {WORDS}) AS words
    FROM documents
), s AS (
    SELECT doc_id, CASE WHEN len(words) = 0 THEN []
        WHEN len(words) < 5 THEN [array_to_string(words, ' ')]
        ELSE list_distinct(list_transform(range(1, len(words) - 3), lambda i: array_to_string(words[i:i + 4], ' '))) END AS shingles
    FROM w
), e AS (SELECT doc_id, len(shingles) AS n, unnest(shingles) AS shingle FROM s),
links AS (
    SELECT a.doc_id AS a, b.doc_id AS b FROM e a JOIN e b ON a.shingle = b.shingle AND a.doc_id <> b.doc_id
        AND 100 * least(a.n, b.n) >= 80 * greatest(a.n, b.n)
    GROUP BY a.doc_id, b.doc_id, a.n, b.n HAVING 100 * count(*) >= 80 * (a.n + b.n - count(*))
), reach AS (
    SELECT doc_id, doc_id AS other FROM documents
    UNION SELECT r.doc_id, l.b FROM reach r JOIN links l ON l.a = r.other
), component AS (SELECT doc_id, min(other) AS component_id FROM reach GROUP BY doc_id)
SELECT s.doc_id, CAST(len(shingles) AS BIGINT) AS n_shingles, component_id FROM s JOIN component USING (doc_id)
"""

# Words in repeated windows: of 3 words in all windows found twice or more, else in later ones.
_COVERED = """
c{n} AS (
    SELECT DISTINCT doc_id, place + k AS place FROM (
        SELECT doc_id, place, {rank} OVER (PARTITION BY doc_id, words[place:place + {n} - 1] {order}) AS times
        FROM (SELECT doc_id, words, unnest(range(1, len(words) - {n} + 2)) AS place FROM w)
    ), range(0, {n}) AS r(k) WHERE times > 1
)"""


def _covered_chars(n: int, name: str) -> str:
    return f"""(SELECT coalesce(sum(length(w.words[c.place])), 0) FROM c{n} c WHERE c.doc_id = w.doc_id) AS {name}"""


OP1 = rf"""
WITH w AS (
    SELECT doc_id, coalesce(text, '') AS body, regexp_extract_all(coalesce(text, ''), {WORDS}) AS words FROM documents
), {_COVERED.format(n=3, rank="count(*)", order="")},
{",".join(_COVERED.format(n=n, rank="row_number()", order="ORDER BY place") for n in (5, 7, 10))},
line AS (
    SELECT doc_id, line, count(*) AS times FROM (SELECT doc_id, unnest(string_split(body, chr(10))) AS line FROM w)
    WHERE regexp_matches(line, {WORDS}) GROUP BY doc_id, line
), repeated AS (
    SELECT doc_id, sum(times - 1) AS n_dup_lines, sum((times - 1) * length(line)) AS dup_line_chars
    FROM line GROUP BY doc_id
), measured AS (
    SELECT w.doc_id, len(words) AS n_words, coalesce(list_sum(list_transform(words, lambda x: length(x))), 0) AS word_chars,
        len(regexp_extract_all(body, '[#*$%&|<>]')) AS n_symbols,
        coalesce(n_dup_lines, 0) AS n_dup_lines,
        (SELECT count(*) FROM c3 c WHERE c.doc_id = w.doc_id) AS n_repeat_words,
        coalesce(dup_line_chars, 0) AS dup_line_chars,
        {_covered_chars(5, "dup_5gram_chars")}, {_covered_chars(7, "dup_7gram_chars")},
        {_covered_chars(10, "dup_10gram_chars")}
    FROM w LEFT JOIN repeated USING (doc_id)
), judged AS (SELECT *, n_words < 50 OR 100 * n_repeat_words > 50 * n_words AS base_failed FROM measured)
SELECT doc_id, CAST(n_words AS BIGINT) AS n_words, CAST(word_chars AS BIGINT) AS word_chars,
    CAST(n_symbols AS BIGINT) AS n_symbols, CAST(n_dup_lines AS BIGINT) AS n_dup_lines,
    CAST(n_repeat_words AS BIGINT) AS n_repeat_words, CAST(dup_line_chars AS BIGINT) AS dup_line_chars,
    CAST(dup_5gram_chars AS BIGINT) AS dup_5gram_chars, CAST(dup_7gram_chars AS BIGINT) AS dup_7gram_chars,
    CAST(dup_10gram_chars AS BIGINT) AS dup_10gram_chars, base_failed,
    NOT base_failed AND 100 * dup_line_chars <= 20 * word_chars AND 100 * dup_5gram_chars <= 15 * word_chars
        AND 100 * dup_7gram_chars <= 13 * word_chars AND 100 * dup_10gram_chars <= 10 * word_chars AS kept
FROM judged
"""

# The same tree, shared out level by level: children by how soon they are used up.
_LEVEL = """
{name}_children AS (
    SELECT {columns}, sum(capacity)::HUGEINT AS capacity, {weight} AS weight FROM leaves GROUP BY {columns}
), {name}_left AS (
    SELECT c.*, b.budget - coalesce(sum(capacity) OVER (PARTITION BY {parents} ORDER BY capacity / weight, {name}
            ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS room,
        sum(weight) OVER (PARTITION BY {parents} ORDER BY capacity / weight, {name}
            ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING) AS load,
        row_number() OVER (PARTITION BY {parents} ORDER BY capacity / weight, {name}) AS place
    FROM {name}_children c JOIN {above} b ON {meet}
), {name}_first AS (
    SELECT {group_columns} arg_min(room, place) AS room, arg_min(load, place) AS load, min(place) AS place
    FROM {name}_left WHERE room * weight <= capacity * load {group}
), {name}_budget AS (
    SELECT {own_columns}, CASE WHEN l.place >= f.place
        THEN least((greatest(f.room, 0) * l.weight) // f.load, l.capacity) ELSE l.capacity END AS budget
    FROM {name}_left l LEFT JOIN {name}_first f ON {first_meet}
)"""


def _level(name: str, parents: list[str], weight: str) -> str:
    columns = [*parents, name]
    return _LEVEL.format(
        name=name,
        columns=", ".join(columns),
        weight=weight,
        parents=", ".join(f"c.{p}" for p in parents) or "1",
        above=f"{parents[-1]}_budget" if parents else "root",
        meet=" AND ".join(f"c.{p} = b.{p}" for p in parents) or "true",
        group_columns="".join(f"{p}, " for p in parents),
        group=f"GROUP BY {', '.join(parents)}" if parents else "",
        own_columns=", ".join(f"l.{c}" for c in columns),
        first_meet=" AND ".join(f"l.{p} = f.{p}" for p in parents) or "true",
    )


def _order(epoch: str) -> str:
    return f"('0x' || substr(md5('17:' || ({epoch}) || ':' || identity), 1, 15))::BIGINT"


def mixed_sql(documents: str) -> str:
    """The mixture of a table with columns doc_id, text, lang and source."""
    return rf"""
marked AS (
    SELECT *, ['web', 'reference', 'forum', 'news'][1 +
            ('0x' || substr(md5(coalesce(source, 'unknown')), 1, 8))::BIGINT % 4] AS mix_domain,
        coalesce(lang, 'unknown') AS mix_lang, coalesce(source, 'unknown') AS mix_source,
        len(regexp_extract_all(coalesce(text, ''), {WORDS})) AS mix_tokens,
        coalesce(doc_id::VARCHAR, '') || ':' || coalesce('t' || md5(text), 'n') AS identity
    FROM {documents}
), root AS (SELECT sum(mix_tokens) * 3 // 4 AS budget FROM marked),
leaves AS (
    SELECT mix_domain, mix_lang, mix_source, sum(mix_tokens) AS tokens, 2 * sum(mix_tokens) AS capacity
    FROM marked GROUP BY ALL HAVING sum(mix_tokens) > 0
), {_level("mix_domain", [], "CASE mix_domain WHEN 'web' THEN 4 WHEN 'reference' THEN 3 WHEN 'forum' THEN 2 ELSE 1 END")},
{_level("mix_lang", ["mix_domain"], "CASE mix_lang WHEN 'en' THEN 6 WHEN 'de' THEN 2 ELSE 1 END")},
{_level("mix_source", ["mix_domain", "mix_lang"], "1")},
planned AS (
    SELECT leaves.*, least(budget // tokens, 2) AS whole, budget - least(budget // tokens, 2) * tokens AS rest
    FROM leaves JOIN mix_source_budget USING (mix_domain, mix_lang, mix_source)
), placed AS (
    SELECT m.*, whole, rest, {_order("whole + 1")} AS place
    FROM marked m JOIN planned USING (mix_domain, mix_lang, mix_source)
), summed AS (
    SELECT *, sum(mix_tokens) OVER (PARTITION BY mix_domain, mix_lang, mix_source ORDER BY place
        RANGE BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS through FROM placed
), mixed AS (
    SELECT *, unnest(range(1, (whole + 1 + CASE WHEN rest > 0 AND through <= rest THEN 1 ELSE 0 END)::BIGINT)) AS mix_epoch
    FROM summed
)"""


OP8 = f"""
WITH {mixed_sql("documents")}
SELECT doc_id, mix_domain, mix_lang, mix_source, CAST(mix_tokens AS BIGINT) AS mix_tokens,
    CAST(mix_epoch AS BIGINT) AS mix_epoch
FROM mixed
"""

OP4 = rf"""
WITH RECURSIVE l AS (
    SELECT doc_id, unnest(string_split(text, chr(10))) AS line,
        generate_subscripts(string_split(text, chr(10)), 1) - 1 AS place FROM documents WHERE text IS NOT NULL
), p AS (
    SELECT *, regexp_extract_all(translate(line, '{UPPER}', '{LOWER}'), {WORDS}) AS words,
        coalesce(sum(length(line) + 1) OVER (PARTITION BY doc_id ORDER BY place
            ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS start
    FROM l
), s AS (
    SELECT row_number() OVER (ORDER BY doc_id, place) AS id, *,
        list_distinct(list_transform(range(1, len(words) - 3), lambda i: array_to_string(words[i:i + 4], ' '))) AS shingles
    FROM p WHERE len(words) >= 20
), e AS (SELECT id, len(shingles) AS n, unnest(shingles) AS shingle FROM s),
links AS (
    SELECT a.id AS a, b.id AS b FROM e a JOIN e b ON a.shingle = b.shingle AND a.id <> b.id
        AND 100 * least(a.n, b.n) >= 80 * greatest(a.n, b.n)
    GROUP BY a.id, b.id, a.n, b.n HAVING 100 * count(*) >= 80 * (a.n + b.n - count(*))
), reach AS (
    SELECT DISTINCT a AS id, a AS other FROM links UNION SELECT r.id, l.b FROM reach r JOIN links l ON l.a = r.other
), component AS (SELECT id, min(other) AS keeper FROM reach GROUP BY id)
SELECT s.doc_id, CAST(s.place AS BIGINT) AS line, CAST(s.start AS BIGINT) AS start,
    CAST(s.start + length(s.line) AS BIGINT) AS "end", CAST(len(s.words) AS BIGINT) AS n_words,
    k.doc_id AS keep_id, CAST(k.place AS BIGINT) AS keep_line, s.id <> k.id AS removed
FROM component c JOIN s ON s.id = c.id JOIN s k ON k.id = c.keeper
"""


# Runs of 50 words: windows that occur again, joined where they overlap with the same shift to their keeper.
RUNS = rf"""
WITH texts AS (
    SELECT doc_id, text, min(doc_id) OVER (PARTITION BY text) AS first, count(*) OVER (PARTITION BY text) AS times
    FROM documents WHERE text IS NOT NULL
), t AS (SELECT *, regexp_extract_all(text, '[^\x20\x09-\x0D]+|[\x20\x09-\x0D]+') AS tokens FROM texts),
tokens AS (SELECT doc_id, first, times, unnest(tokens) AS token, generate_subscripts(tokens, 1) AS i FROM t),
placed AS (
    SELECT *, sum(length(token)) OVER (PARTITION BY doc_id ORDER BY i) AS stop FROM tokens
), words AS (
    SELECT doc_id, first, times, translate(token, '{UPPER}', '{LOWER}') AS word, stop - length(token) AS start, stop,
        row_number() OVER (PARTITION BY doc_id ORDER BY i) - 1 AS place
    FROM placed WHERE NOT regexp_matches(token, '^[\x20\x09-\x0D]')
), w AS (
    SELECT doc_id, times, place, start, md5(string_agg(word, ' ') OVER ahead) AS hash, max(stop) OVER ahead AS stop, count(*) OVER ahead AS n
    FROM words WHERE doc_id = first WINDOW ahead AS (PARTITION BY doc_id ORDER BY place ROWS BETWEEN CURRENT ROW AND 49 FOLLOWING)
), k AS (
    SELECT hash, min((doc_id, place, start)) AS keep FROM w WHERE n = 50 GROUP BY hash HAVING sum(times) > 1
), found AS (
    SELECT doc_id, place, start, stop, keep[1] AS keep_id, keep[2] - place AS shift, keep[3] AS keep_start FROM w JOIN k USING (hash) WHERE n = 50
), fresh AS (
    SELECT *, coalesce(place >= max(place + 50) OVER (PARTITION BY doc_id, keep_id, shift ORDER BY place
        ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), true) AS begins FROM found
), runs AS (
    SELECT *, sum(CAST(begins AS BIGINT)) OVER (PARTITION BY doc_id, keep_id, shift ORDER BY place) AS run FROM fresh
)
SELECT doc_id, CAST(min(start) AS BIGINT) AS start, CAST(max(stop) AS BIGINT) AS "end",
    CAST(max(place) + 50 - min(place) AS BIGINT) AS n_words, keep_id, CAST(min(keep_start) AS BIGINT) AS keep_start,
    doc_id <> keep_id OR shift <> 0 AS removed
FROM runs GROUP BY doc_id, keep_id, shift, run
UNION ALL
SELECT doc_id, CAST(min(start) AS BIGINT), CAST(max(stop) AS BIGINT), count(*), first, CAST(min(start) AS BIGINT), true
FROM words WHERE doc_id <> first GROUP BY doc_id, first HAVING count(*) >= 50
"""


def _crc32(text: str) -> str:
    """CRC-32 of an ASCII text: the bits of each byte, one after the other."""
    bit = "xor(c >> 1, (c & 1) * 3988292384)"
    byte = f"list_reduce([xor(crc, b), 0, 0, 0, 0, 0, 0, 0, 0], lambda c, n: {bit})"
    codes = f"list_transform(string_split({text}, ''), lambda x: CAST(ascii(x) AS BIGINT))"
    return f"xor(list_reduce(list_prepend(CAST(4294967295 AS BIGINT), {codes}), lambda crc, b: {byte}), 4294967295)"


TIE = "md5(length(role) || ':' || role || text)"


def _edit(state: int, following: int, role: str) -> str:
    """Cheapest of the edits at a turn from a state: (cost, letters, lines), before turns are put in."""
    kept = {0: "CASE initial WHEN 's' THEN 2 WHEN 'u' THEN 3 END", 2: "CASE initial WHEN 'a' THEN 4 END"}
    after = kept.get(state, "CASE initial WHEN 'u' THEN 3 END")
    gone = f"struct_pack(cost := 2 + b[{state + 1}].cost, audit := 'D' || b[{state + 1}].audit, lines := b[{state + 1}].lines)"

    def stays(letter: str, cost: str, to: str, written: str) -> str:
        fields = f"cost := {cost} + 5 * cut + b[{to}].cost, audit := '{letter}' || b[{to}].audit"
        return f"struct_pack({fields}, lines := list_prepend({written} || ':' || text, b[{to}].lines))"

    keep = f"CASE WHEN NOT must_go AND {after} IS NOT NULL THEN {stays('K', '0', after, 'role')} END"
    rerole = f"CASE WHEN NOT must_go THEN {stays('R', '1', str(following + 1), repr(role))} END"
    return f"list_min(list_filter([{gone}, {keep}, {rerole}], lambda x: x IS NOT NULL))"


def _inserted(name: str, state: int, following: int, role: str) -> str:
    """The cheaper of what a state has and of putting a turn in first."""
    other = f"{name}[{following + 1}]"
    put = f"struct_pack(cost := 5 + {other}.cost, audit := 'I' || {other}.audit, lines := list_prepend('{role}:', {other}.lines))"
    return f"list_min([{name}[{state + 1}], {put}])"


_FOLLOWING = [(0, 2, "user"), (1, 2, "user"), (2, 3, "assistant"), (3, 2, "user")]
_STEP = "[" + ", ".join(_edit(state, to, role) for state, to, role in _FOLLOWING) + "]"
_PUT = "[" + ", ".join(_inserted("e", state, to, role) for state, to, role in _FOLLOWING) + "]"
_END = [(0, "", []), (10, "II", ["user:", "assistant:"]), (5, "I", ["assistant:"]), (0, "", [])]
_LAST = ", ".join(f"struct_pack(cost := CAST({c} AS BIGINT), audit := '{a}', lines := CAST({w} AS VARCHAR[]))" for c, a, w in _END)

OP11 = rf"""
WITH RECURSIVE hashed AS (
    SELECT conv_id, turn, coalesce(role, ' ') AS role, coalesce(text, ' ') AS text,
        {_crc32("(coalesce(CAST(conv_id AS VARCHAR), ' ') || ':' || coalesce(CAST(turn AS VARCHAR), ' '))")} % 20 AS fault
    FROM conversations
), once AS (
    SELECT conv_id, turn, CASE WHEN fault = 4 THEN 'user' ELSE role END AS role, fault,
        CASE fault WHEN 1 THEN '' WHEN 2 THEN regexp_replace(text, '[.!?]', '', 'g') ELSE text END AS text
    FROM hashed WHERE fault <> 0
), damaged AS (SELECT * FROM once UNION ALL SELECT * FROM once WHERE fault = 3),
placed AS (
    SELECT *, row_number() OVER (PARTITION BY conv_id ORDER BY turn NULLS FIRST, {TIE}) AS place, role[1] AS initial,
        NOT regexp_matches(text, '[^\x20\x09-\x0D]') AS blank
    FROM damaged
), seen AS (
    SELECT *, NOT blank AND row_number() OVER (PARTITION BY conv_id, role, text ORDER BY place) > 1 AS duplicate,
        lag(initial) OVER (PARTITION BY conv_id ORDER BY place) AS before
    FROM placed
), marked AS (
    SELECT *, blank OR duplicate AS must_go,
        CAST(NOT blank AND NOT duplicate AND NOT regexp_matches(text, '[.!?][\x20\x09-\x0D]*$') AS BIGINT) AS cut
    FROM seen
), counted AS (
    SELECT conv_id, coalesce(max(turn) - min(turn) + 1 - count(DISTINCT turn), 0) AS gaps, count(*) AS n,
        count(*) FILTER (WHERE blank) AS blank, count(*) FILTER (WHERE duplicate) AS duplicate, sum(cut) AS truncated,
        count(*) FILTER (WHERE before || initial NOT IN ('su', 'ua', 'au')) AS illegal
    FROM marked GROUP BY conv_id
), walk AS (
    SELECT conv_id, n + 1 AS place, [{_LAST}] AS b FROM counted
    UNION ALL
    SELECT conv_id, place, {_PUT} FROM (
        SELECT conv_id, place, {_PUT} AS e FROM (
            SELECT w.conv_id, m.place, {_STEP} AS e
            FROM walk w JOIN marked m ON m.conv_id IS NOT DISTINCT FROM w.conv_id AND m.place = w.place - 1
        )
    )
)
SELECT c.conv_id, CAST(coalesce(gaps, 0) AS BIGINT) AS gaps, CAST(coalesce(blank, 0) AS BIGINT) AS blank,
    CAST(coalesce(duplicate, 0) AS BIGINT) AS duplicate, CAST(coalesce(truncated, 0) AS BIGINT) AS truncated,
    CAST(coalesce(illegal, 0) AS BIGINT) AS illegal, coalesce(b[1].cost, 0) AS cost, coalesce(b[1].audit, '') AS audit,
    sha256(coalesce(array_to_string(b[1].lines, chr(10)), '')) AS repaired_sha256
FROM (SELECT DISTINCT conv_id FROM conversations) c
LEFT JOIN counted n ON n.conv_id IS NOT DISTINCT FROM c.conv_id
LEFT JOIN walk w ON w.conv_id IS NOT DISTINCT FROM c.conv_id AND w.place = 1
"""

OP13 = rf"""
WITH texts AS (
    SELECT conv_id, turn, coalesce(role, '') AS role, coalesce(text, '') AS text FROM conversations WHERE conv_id IS NOT NULL
), own AS (
    SELECT conv_id, row_number() OVER (PARTITION BY conv_id ORDER BY turn NULLS FIRST, {TIE}) AS place, {TIE} AS name, length(text) AS size
    FROM texts
), convs AS (
    SELECT conv_id, conv_id - conv_id % 100 AS base, {_crc32("CAST(conv_id AS VARCHAR)")} % 6 AS taken
    FROM (SELECT DISTINCT conv_id FROM own)
), heads AS (
    SELECT c.conv_id, o.place AS depth, name, size FROM convs c JOIN own o ON o.conv_id = c.base AND o.place <= c.taken
), begun AS (SELECT conv_id, count(*) AS n FROM heads GROUP BY conv_id),
rebuilt AS (
    SELECT * FROM heads
    UNION ALL
    SELECT o.conv_id, o.place - c.taken + coalesce(b.n, 0), name, size
    FROM own o JOIN convs c USING (conv_id) LEFT JOIN begun b USING (conv_id) WHERE o.place > c.taken
), paths AS (
    SELECT conv_id, depth, size, list(name) OVER (PARTITION BY conv_id ORDER BY depth) AS path,
        depth = count(*) OVER (PARTITION BY conv_id) AS ends
    FROM rebuilt
    UNION ALL
    SELECT conv_id, 0, 0, [], conv_id NOT IN (SELECT conv_id FROM rebuilt) FROM convs
), nodes AS (
    SELECT path, depth, min(conv_id) AS conv_id, count(*) AS n_convs, min(size) AS size,
        coalesce(string_agg(CAST(conv_id AS VARCHAR), ',' ORDER BY conv_id) FILTER (WHERE ends), '') AS ended
    FROM paths GROUP BY path, depth
), children AS (SELECT path[1:depth - 1] AS path, count(*) AS n FROM nodes WHERE depth > 0 GROUP BY ALL),
below AS (
    SELECT path[1:d] AS path, count(*) FILTER (WHERE n IS NULL) AS n_leaves, sum((n_convs - 1) * size) AS saved
    FROM (SELECT n.*, c.n, unnest(range(0, depth + 1)) AS d FROM nodes n LEFT JOIN children c USING (path)) GROUP BY ALL
)
SELECT n.conv_id, CAST(n.depth AS BIGINT) AS depth, p.conv_id AS parent_conv_id, n.n_convs, coalesce(c.n, 0) AS n_children,
    b.n_leaves, CAST(b.saved AS BIGINT) AS saved_tokens, sha256(n.ended) AS ends_sha256
FROM nodes n JOIN below b USING (path) LEFT JOIN children c USING (path)
LEFT JOIN nodes p ON n.depth > 0 AND p.path = n.path[1:n.depth - 1]
"""

ORACLE = {
    "op1_repetition_rules": OP1,
    "op4_paragraph_repeats": f"SELECT * FROM ({OP4}) UNION ALL BY NAME SELECT * EXCLUDE (keep_start) FROM ({RUNS})",
    "op4_passage_repeats": RUNS,
    "op7_jaccard_join": OP7,
    "op8_source_mix": OP8,
    "op11_conversation_repair": OP11,
    "op13_prefix_trie": OP13,
}
