"""The same results in SQL for DuckDB, where SQL can express them."""

from __future__ import annotations

from caudal.llm import merkle, spelling
from caudal.llm.quality import MIN_WORDS, REPEATED_PERCENT, RULES, STOP_WORDS

_UPPER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"
_LOWER = f"translate(coalesce(text, ''), '{_UPPER}', '{_UPPER.lower()}')"

_STOPS = ", ".join(f"'{word}'" for word in STOP_WORDS)
_PASSED = " AND ".join(
    f"CASE WHEN {r.under} > 0 THEN {r.over} / {r.under} ELSE 0 END BETWEEN {r.least} AND {r.most}"
    for r in RULES)

# The table of CRC-32 by its rule, and the checksum of a text by its UTF-8 bytes.
_CRC_TABLE = """crc_table AS (
    SELECT list_transform(range(256), lambda x: list_reduce(list_prepend(x, range(8)),
        lambda c, i: CASE WHEN c & 1 = 1 THEN xor(c >> 1, 3988292384) ELSE c >> 1 END)) AS t)"""


def _crc32(text: str) -> str:
    """SQL of the unsigned CRC-32 of a text, where `crc_table` is in the FROM clause."""
    digits = f"hex(encode({text}))"
    return f"""xor(4294967295, list_reduce(
        list_prepend(4294967295::BIGINT, list_transform(range(0, length({digits}) // 2),
            lambda i: ('0x' || substr({digits}, 2 * i + 1, 2))::BIGINT)),
        lambda c, b: xor(c >> 8, t[(xor(c, b) & 255) + 1])))"""


def _spelling() -> str:
    """Words by deletions: two words are near if a letter less makes them equal at the same place, or one the other."""
    least, every = spelling.LEAST, spelling.DROP_EVERY
    lower = _LOWER.replace("coalesce(text, '')", "run")
    hops = "\n".join(f"""
        r{n + 1} AS (SELECT r{n}.word, coalesce(f.form, r{n}.root) AS root
                     FROM r{n} LEFT JOIN known f ON f.word = r{n}.root),""" for n in range(8))
    return f"""
        WITH {_CRC_TABLE},
        runs AS (SELECT doc_id, {lower} AS run FROM (
            SELECT doc_id, unnest(regexp_extract_all(text, '[A-Za-z\\x{{00C0}}-\\x{{00FF}}]+')) AS run FROM documents)),
        per AS (SELECT doc_id, run, count(*) AS k FROM runs WHERE length(run) >= {least} GROUP BY ALL),
        sums AS (SELECT *, {_crc32("coalesce(doc_id::VARCHAR, '') || ':' || run")} AS h FROM per, crc_table),
        spelled AS (SELECT k, CASE WHEN h % {every} = 0
            THEN substr(run, 1, h % length(run)) || substr(run, h % length(run) + 2) ELSE run END AS word FROM sums),
        words AS (SELECT word, sum(k)::BIGINT AS n FROM spelled WHERE length(word) >= {least}
                  GROUP BY word HAVING sum(k) >= {spelling.MIN_COUNT}),
        less AS (SELECT word, n, i, substr(word, 1, i) || substr(word, i + 2) AS rest
                 FROM (SELECT word, n, unnest(range(0, length(word))) AS i FROM words)),
        pairs AS (
            SELECT a.word, b.word AS near, b.n AS near_n FROM less a JOIN less b USING (i, rest) WHERE a.word <> b.word
            UNION SELECT a.word, b.word, b.n FROM less a JOIN words b ON a.rest = b.word
            UNION SELECT b.word, a.word, a.n FROM less a JOIN words b ON a.rest = b.word),
        stats AS (SELECT word, count(*) AS n_near, max(near_n) AS best_n FROM pairs GROUP BY word),
        best AS (SELECT s.*, min(p.near) AS best FROM stats s
                 JOIN pairs p ON p.word = s.word AND p.near_n = s.best_n GROUP BY ALL),
        known AS (SELECT w.word, w.n, coalesce(n_near, 0) AS n_near,
                         CASE WHEN best_n >= {spelling.RATIO} * w.n THEN best END AS form,
                         CASE WHEN best_n >= {spelling.RATIO} * w.n THEN best_n END AS form_n
                  FROM words w LEFT JOIN best ON best.word = w.word),
        r0 AS (SELECT word, word AS root FROM known),{hops}
        last AS (SELECT * FROM r8)
        SELECT k.word, k.form, last.root, k.n, k.n_near, k.form_n FROM known k JOIN last ON last.word = k.word
    """


def _tree(leaves: str, name: str, by: str, levels: int, fanout: int) -> str:
    """CTEs of the trees over `leaves` (by, place, digest): a row per leaf and level, with its siblings."""
    out = [f"{name}0 AS (SELECT *, count(*) OVER (PARTITION BY {by}) AS nodes FROM {leaves})"]
    for n in range(levels):
        out.append(f"""{name}{n + 1} AS (
            SELECT {by}, place // {fanout} AS place,
                   CASE WHEN any_value(nodes) > 1 THEN sha256(string_agg(digest, '' ORDER BY place))
                        ELSE any_value(digest) END AS digest, ceil(any_value(nodes) / {fanout})::BIGINT AS nodes
            FROM {name}{n} GROUP BY {by}, place // {fanout})""")
    return ",\n".join(out)


def _climb(start: str, name: str, tree: str, by: str, levels: int, fanout: int) -> str:
    """CTEs that climb from `start` (row, by, place, folded, proof): siblings join the proof and fold the digest."""
    out = [f"{name}0 AS (SELECT row, {by}, place, folded, proof FROM {start})"]
    for n in range(levels):
        inner = f"{name}{n}"
        out.append(f"""{name}{n + 1} AS (
            SELECT c.row, c.{by}, c.place // {fanout} AS place,
                   CASE WHEN any_value(s.nodes) > 1 THEN sha256(string_agg(
                       CASE WHEN s.place = c.place THEN c.folded ELSE s.digest END, '' ORDER BY s.place))
                       ELSE c.folded END AS folded,
                   c.proof || coalesce(string_agg(s.digest, '' ORDER BY s.place) FILTER (s.place <> c.place), '') AS proof
            FROM {inner} c JOIN {tree}{n} s ON s.{by} = c.{by} AND s.place // {fanout} = c.place // {fanout}
            GROUP BY c.row, c.{by}, c.place, c.folded, c.proof)""")
    return ",\n".join(out)


def _merkle(levels: int = 6) -> str:
    """Trees of up to `levels` levels, so 16 ** 6 rows of a source and as many sources."""
    fanout = merkle.FANOUT

    def leaf(last: str) -> str:
        fields = [*(f"{name}::VARCHAR" for name in merkle.FIELDS[:-1]), last]
        return "sha256(" + " || ".join(
            f"coalesce(octet_length(encode({f})) || ':' || {f}, '-')" for f in fields) + ")"

    changed = _LOWER.replace("coalesce(text, '')", "text")
    return f"""
        WITH {_CRC_TABLE},
        leaves AS (SELECT doc_id, {leaf('text')} AS leaf,
                          CASE WHEN {_crc32("doc_id::VARCHAR")} % {merkle.TAMPER} = 0
                               THEN {leaf(changed)} ELSE {leaf('text')} END AS other,
                          dense_rank() OVER (ORDER BY encode(source) NULLS FIRST) - 1 AS src
                   FROM documents, crc_table),
        numbered AS (SELECT *, row_number() OVER () AS row,
                            row_number() OVER (PARTITION BY src ORDER BY doc_id NULLS FIRST, leaf) - 1 AS place
                     FROM leaves),
        base AS (SELECT src, place, leaf AS digest FROM numbered),
        {_tree("base", "a", "src", levels, fanout)},
        subroots AS (SELECT 0 AS everything, src AS place, digest FROM a{levels}),
        {_tree("subroots", "b", "everything", levels, fanout)},
        start AS (SELECT row, src, place, other AS folded, '' AS proof FROM numbered),
        {_climb("start", "c", "a", "src", levels, fanout)},
        upper AS (SELECT row, 0 AS everything, src AS place, folded, proof FROM c{levels}),
        {_climb("upper", "d", "b", "everything", levels, fanout)}
        SELECT n.doc_id, n.leaf, s.digest AS subroot, r.digest AS root, sha256(d.proof) AS proof_sha256,
               d.folded AS folded_root, d.folded = r.digest AS verified
        FROM numbered n JOIN d{levels} d ON d.row = n.row JOIN a{levels} s ON s.src = n.src, b{levels} r
    """


ORACLE: dict[str, str] = {
    "op3_quality": f"""
        WITH d AS (
            SELECT doc_id, coalesce(text, '') AS t,
                   list_filter(string_split_regex(coalesce(text, ''), '[\\x20\\x09-\\x0D]+'),
                               lambda x: x <> '') AS words,
                   list_filter(string_split(coalesce(text, ''), chr(10)),
                               lambda x: regexp_matches(x, '[^\\x20\\x09-\\x0D]')) AS lines
            FROM documents),
        w AS (SELECT doc_id, i, words[i] || ' ' || words[i + 1] || ' ' || words[i + 2] AS g
              FROM (SELECT doc_id, words, unnest(range(1, len(words) - 1)) AS i FROM d)),
        again AS (SELECT doc_id, i, count(*) OVER (PARTITION BY doc_id, g) AS n FROM w),
        covered AS (SELECT doc_id, count(DISTINCT place) AS n FROM
                    (SELECT doc_id, unnest([i, i + 1, i + 2]) AS place FROM again WHERE n > 1) GROUP BY doc_id),
        m AS (
            SELECT d.doc_id, len(words) AS n_words,
                   length(list_aggregate(words, 'string_agg', '')) AS chars,
                   length(regexp_replace(t, '[^#*$%&|<>]', '', 'g')) AS n_symbols,
                   length(regexp_replace(t, '[^!]', '', 'g')) AS n_shouts,
                   len(list_filter(words, lambda x: lower(x) IN ({_STOPS}))) AS n_stop_words,
                   len(lines) AS n_lines, len(lines) - len(list_distinct(lines)) AS n_dup_lines,
                   coalesce(covered.n, 0) AS n_repeat_words
            FROM d LEFT JOIN covered ON covered.doc_id = d.doc_id),
        f AS (SELECT * EXCLUDE chars, coalesce(chars, 0) AS word_chars,
                     n_words < {MIN_WORDS} OR 100 * n_repeat_words > {REPEATED_PERCENT} * n_words AS base_failed
              FROM m)
        SELECT *, NOT base_failed AND {_PASSED} AS kept FROM f
    """,
    "op2_exact_dedup": f"""
        WITH d AS (SELECT doc_id, {_LOWER} AS t FROM documents)
        SELECT doc_id, max(doc_id) OVER w AS keep_id, count(*) OVER w AS group_size,
               doc_id = max(doc_id) OVER w AS kept, sha256(t) AS text_sha256
        FROM d WINDOW w AS (PARTITION BY t)
    """,
    "op11_spelling": _spelling(),
    "op12_merkle": _merkle(),
}
