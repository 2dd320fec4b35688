"""DuckDB SQL for the queries that SQL can express: the plain meaning of each, without its index or sketch."""

from __future__ import annotations

from heliovane.llm.conversations import DELETE, INSERT, REROLE, UNFINISHED
from heliovane.llm.lines import THRESHOLDS
from heliovane.llm.phrases import ABSORBED, LEAST, LONGEST, NO_LANGUAGE, SCORE_UNIT, TOP
from heliovane.llm.suffixes import WINDOW

_UPPER, _LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


def line_dedup(thresholds: tuple[tuple[int, int], ...] = THRESHOLDS) -> str:
    steps = " ".join(f"WHEN n >= {words} THEN {edits}" for words, edits in sorted(thresholds, reverse=True))
    most = max(edits for _, edits in thresholds)
    # A segment of the shorter line stands somewhere in the longer one.
    pieces = " OR ".join(
        f"({k} <= a.t AND contains(b.spaced, ' ' || array_to_string("
        f"a.w[{k} * (a.n // (a.t + 1)) + 1 : {k + 1} * (a.n // (a.t + 1))], ' ') || ' '))"
        for k in range(most + 1)
    )
    return f"""WITH RECURSIVE
split AS (SELECT doc_id, string_split(coalesce(text, ''), chr(10)) AS lines FROM documents),
numbered AS (SELECT doc_id, unnest(range(len(lines))) AS line_no, unnest(lines) AS raw FROM split),
found AS (
  SELECT doc_id, line_no, trim(raw, ' ' || chr(9) || chr(13)) AS line,
         (doc_id IS NULL, doc_id, line_no) AS place
  FROM numbered WHERE trim(raw, ' ' || chr(9) || chr(13)) <> ''),
texts AS (
  SELECT row_number() OVER (ORDER BY line) AS id, line, string_split(line, ' ') AS w, ' ' || line || ' ' AS spaced,
         count(*) AS copies, min(place) AS first
  FROM found GROUP BY line),
sized AS (SELECT *, len(w) AS n FROM texts),
limited AS (SELECT *, CASE {steps} ELSE 0 END AS t FROM sized),
offsets AS (SELECT unnest(range({most + 1})) AS d),
pairs AS (
  SELECT a.id AS a, b.id AS b, a.w AS v, b.w AS w, a.t AS t
  FROM limited a, offsets o, limited b
  WHERE b.n = a.n + o.d AND o.d <= a.t AND a.t > 0 AND (a.id < b.id OR o.d > 0) AND ({pieces})),
reach AS (
  SELECT a, b, v, w, t, 0 AS edits, 0::BIGINT AS i, 0::BIGINT AS j FROM pairs
  UNION
  SELECT a, b, v, w, t, edits + 1, i + di, j + dj
  FROM (
    SELECT a, b, v, w, t, edits, i + same AS i, j + same AS j
    FROM (
      SELECT *, coalesce(
               list_position(list_transform(range(least(len(v) - i, len(w) - j)), lambda k: v[i + k + 1] = w[j + k + 1]), false) - 1,
               least(len(v) - i, len(w) - j)) AS same
      FROM reach)
    WHERE edits < t), (VALUES (0, 1), (1, 0), (1, 1)) AS moves(di, dj)
  WHERE i + di <= len(v) AND j + dj <= len(w)),
near AS (
  SELECT DISTINCT a, b FROM reach
  WHERE len(v) - i = len(w) - j AND v[i + 1 :] = w[j + 1 :]),
links AS (SELECT a, b FROM near UNION ALL SELECT b, a FROM near),
reached AS (
  SELECT id, id AS root FROM texts
  UNION
  SELECT l.b, r.root FROM reached r JOIN links l ON l.a = r.id),
named AS (SELECT id, min(root) AS class FROM reached GROUP BY id),
classes AS (
  SELECT class, min(first) AS first, sum(copies)::BIGINT AS lines, count(*) AS texts
  FROM named JOIN texts USING (id) GROUP BY class)
SELECT f.doc_id, f.line_no::INTEGER AS line_no, c.first[2] AS class_doc_id, c.first[3]::INTEGER AS class_line_no,
       c.lines, c.texts, f.place = c.first AS kept
FROM found f JOIN texts t USING (line) JOIN named USING (id) JOIN classes c USING (class)"""


def suffix_dedup(window: int = WINDOW) -> str:
    return f"""WITH
docs AS (SELECT row_number() OVER () AS r, doc_id, hex(encode(coalesce(text, ''))) AS h FROM documents),
windows AS (
  SELECT r, h, unnest(range(length(h) // 2 - {window - 1})) AS s FROM docs WHERE length(h) >= {2 * window}),
sums AS (SELECT r, s, md5(substr(h, 2 * s + 1, {2 * window})) AS m FROM windows),
starts AS (SELECT r, s FROM sums SEMI JOIN (SELECT m FROM sums GROUP BY m HAVING count(*) > 1) USING (m)),
steps AS (SELECT r, s, s <= lag(s) OVER (PARTITION BY r ORDER BY s) + {window} AS joined FROM starts),
numbered AS (
  SELECT r, s, sum(CASE WHEN joined THEN 0 ELSE 1 END) OVER (PARTITION BY r ORDER BY s) AS run FROM steps),
spans AS (SELECT r, min(s) AS a, max(s) + {window} AS b FROM numbered GROUP BY r, run),
cuts AS (
  SELECT r, count(*) AS n_spans, sum(b - a) AS n_removed, list(a ORDER BY a) AS a, list(b ORDER BY a) AS b
  FROM spans GROUP BY r)
SELECT doc_id, length(h) // 2 AS n_bytes, coalesce(n_removed, 0)::BIGINT AS n_removed,
       coalesce(n_spans, 0)::BIGINT AS n_spans,
       CASE WHEN n_spans IS NULL THEN sha256(unhex(h)) ELSE sha256(unhex(array_to_string(list_transform(
         list_zip(list_prepend(0, b), list_append(a, length(h) // 2)),
         lambda x: substr(h, 2 * x[1] + 1, 2 * (x[2] - x[1]))), ''))) END AS kept_sha256,
       (length(h) // 2 - coalesce(n_removed, 0))::BIGINT AS n_kept
FROM docs LEFT JOIN cuts USING (r)"""


def decontaminate(least: float = 0.8, shingle: int = 5) -> str:
    words = r"regexp_extract_all(lower(coalesce(text, '')), '[\p{L}\p{N}_]+')"
    return f"""WITH
docs AS (SELECT row_number() OVER () AS r, doc_id, {words} AS w FROM documents),
items AS (SELECT DISTINCT item_id, {words} AS w FROM benchmark),
sized AS (SELECT item_id, w, len(w) AS m, least({shingle}, len(w)) AS width FROM items WHERE len(w) > 0),
bags AS (
  SELECT item_id, m, width, s, count(*) AS c
  FROM (SELECT item_id, m, width, array_to_string(w[p : p + width - 1], ' ') AS s
        FROM (SELECT *, unnest(range(1, m - width + 2)) AS p FROM sized))
  GROUP BY ALL),
places AS (
  SELECT r, len(w) AS n, width, p, array_to_string(w[p : p + width - 1], ' ') AS s
  FROM (SELECT *, unnest(range(1, len(w) - width + 2)) AS p FROM docs, (SELECT DISTINCT width FROM sized))),
hits AS (
  SELECT DISTINCT r, n, item_id, m, width, p, greatest(1, n - m + 1) AS last FROM places JOIN bags USING (width, s)),
starts AS (
  SELECT DISTINCT r, item_id, m, width, least(m, n) AS size,
         unnest(range(greatest(1, least(last, p + width - m)), least(last, p) + 1)) AS start
  FROM hits),
parts AS (
  SELECT r, item_id, m, width, size, start, unnest(range(start, start + size - width + 1)) AS q FROM starts),
counted AS (
  SELECT r, item_id, m, width, size, start, array_to_string(w[q : q + width - 1], ' ') AS s, count(*) AS k
  FROM parts JOIN docs USING (r) GROUP BY ALL),
shared AS (
  SELECT r, item_id, m, width, size, start, sum(least(k, c)) AS met
  FROM counted JOIN bags USING (item_id, m, width, s) GROUP BY ALL),
ranked AS (
  SELECT *, row_number() OVER (PARTITION BY r, item_id ORDER BY similarity DESC, start) AS place
  FROM (SELECT *, met::DOUBLE / (size + m - 2 * width + 2 - met)::DOUBLE AS similarity FROM shared)
  WHERE similarity >= {least}e0)
SELECT doc_id, item_id, (start - 1)::INTEGER AS start_word, size::INTEGER AS n_words, similarity
FROM ranked JOIN docs USING (r) WHERE place = 1"""


def exact_dedup() -> str:
    return f"""WITH
texts AS (
  SELECT row_number() OVER () AS r, doc_id, translate(coalesce(text, ''), '{_UPPER}', '{_LOWER}') AS t FROM documents)
SELECT doc_id, max(doc_id) OVER (PARTITION BY t) AS keep_id, count(*) OVER (PARTITION BY t) AS group_size,
       row_number() OVER (PARTITION BY t ORDER BY doc_id DESC NULLS LAST, r) = 1 AS kept, sha256(t) AS text_sha256
FROM texts"""


def collocations(least: int = LEAST, longest: int = LONGEST, absorbed: int = ABSORBED, top: int = TOP) -> str:
    grams = " UNION ALL ".join(
        f"SELECT lang, {k} AS k, array_to_string(w[p : p + {k - 1}], ' ') AS phrase"
        f" FROM (SELECT lang, w, unnest(range(1, len(w) - {k - 2})) AS p FROM pieces)"
        for k in range(1, longest + 1)
    )
    return f"""WITH
texts AS (
  SELECT coalesce(lang, '{NO_LANGUAGE}') AS lang,
         translate(coalesce(text, ''), '{_UPPER}' || chr(9), '{_LOWER} ') AS t FROM documents),
parts AS (SELECT lang, unnest(string_split_regex(t, '[.,;:!?\\x0A-\\x0D]')) AS piece FROM texts),
pieces AS (SELECT lang, list_filter(string_split(piece, ' '), lambda x: x <> '') AS w FROM parts),
grams AS ({grams}),
sizes AS (SELECT lang, sum(len(w))::BIGINT AS n FROM pieces GROUP BY lang),
found AS (SELECT lang, k, phrase, count(*) AS f FROM grams GROUP BY ALL HAVING count(*) >= {least}),
cuts AS (
  SELECT lang, phrase, f AS a, string_split(phrase, ' ') AS w, unnest(range(1, k)) AS cut FROM found WHERE k >= 2),
scored AS (
  SELECT c.lang, c.phrase, c.a, c.cut, x.f AS l, y.f AS r, ({SCORE_UNIT} * c.a::HUGEINT // (x.f + y.f))::BIGINT AS score
  FROM cuts c
  JOIN found x ON x.lang = c.lang AND x.phrase = array_to_string(c.w[: c.cut], ' ')
  JOIN found y ON y.lang = c.lang AND y.phrase = array_to_string(c.w[c.cut + 1 :], ' ')),
lowest AS (SELECT * FROM scored QUALIFY row_number() OVER (PARTITION BY lang, phrase ORDER BY score, cut) = 1),
inner_parts AS (
  SELECT lang, f, array_to_string(w[i : i + s - 1], ' ') AS phrase
  FROM (SELECT *, unnest(range(1, k - s + 2)) AS i
        FROM (SELECT lang, f, k, string_split(phrase, ' ') AS w, unnest(range(2, k)) AS s FROM found WHERE k >= 3))),
longer AS (SELECT lang, phrase, max(f) AS f FROM inner_parts GROUP BY ALL),
kept AS (
  SELECT s.* FROM lowest s LEFT JOIN longer o USING (lang, phrase)
  WHERE o.f IS NULL OR 100 * o.f::HUGEINT < {absorbed} * s.a::HUGEINT)
SELECT lang, rank, phrase, a, l, r, n, score
FROM (SELECT *, row_number() OVER (PARTITION BY lang ORDER BY score DESC, a DESC, phrase) AS rank FROM kept)
JOIN sizes USING (lang) WHERE rank <= {top}"""


def conversation_repair() -> str:
    def extended(state: str, cost: str, letter: str, line: str) -> str:
        return (
            f"CASE WHEN {state} IS NOT NULL THEN"
            f" {{'c': {state}.c + {cost}, 'e': {state}.e || '{letter}', 'o': {state}.o || {line}}} END"
        )

    def inserted(state: str, role: str) -> str:
        return extended(state, str(INSERT), "I", f"[{role!r} || ':']")

    def deleted(state: str) -> str:
        return extended(state, str(DELETE), "D", "[]::VARCHAR[]")

    def kept(state: str, initial: str) -> str:
        way = extended(state, "extra", "K", "[role || ':' || text]")
        return f"CASE WHEN NOT must_go AND ini = '{initial}' THEN {way} END"

    def changed(state: str, role: str) -> str:
        way = extended(state, f"extra + {REROLE}", "R", f"[{role!r} || ':' || text]")
        return f"CASE WHEN NOT must_go THEN {way} END"

    to_user = ", ".join([*(kept(s, "u") for s in "zsa"), *(changed(s, "user") for s in "zsa")])
    white = "[^\\x20\\x09-\\x0D]"
    return f"""WITH RECURSIVE
tab AS (
  SELECT list_transform(range(256), lambda n: list_reduce(
    list_concat([n], range(8)), lambda c, k: CASE WHEN c & 1 = 1 THEN xor(3988292384, c >> 1) ELSE c >> 1 END)) AS t),
source AS (
  SELECT row_number() OVER () AS r, dense_rank() OVER (ORDER BY conv_id) AS g, conv_id, turn,
         coalesce(role, ' ') AS role, coalesce(text, ' ') AS text,
         coalesce(conv_id::VARCHAR, ' ') || ':' || coalesce(turn::VARCHAR, ' ') AS name
  FROM conversations),
kinds AS (
  SELECT source.*, xor(list_reduce(
    list_concat([4294967295], list_transform(string_split(name, ''), lambda x: ascii(x)::BIGINT)),
    lambda c, b: xor(c >> 8, t[(xor(c, b) & 255) + 1])), 4294967295) % 20 AS kind
  FROM source, tab),
hurt AS (
  SELECT r, g, turn, CASE WHEN kind = 4 THEN 'user' ELSE role END AS role,
         CASE kind WHEN 1 THEN '' WHEN 2 THEN regexp_replace(text, '[.!?]', '', 'g') ELSE text END AS text,
         unnest(range(CASE WHEN kind = 3 THEN 2 ELSE 1 END)) AS copy
  FROM kinds WHERE kind <> 0),
numbered AS (
  SELECT *, row_number() OVER (PARTITION BY g ORDER BY turn NULLS FIRST, role, text, r, copy) AS i,
         left(role, 1) AS ini, regexp_extract(text, '(?s)({white})[\\x20\\x09-\\x0D]*$', 1) AS ending
  FROM hurt),
marked AS (
  SELECT *, row_number() OVER (PARTITION BY g, role, text ORDER BY i) > 1 AS again,
         lag(ini) OVER (PARTITION BY g ORDER BY i) AS previous
  FROM numbered),
turns AS (
  SELECT g, i, turn, role, text, ini, ending = '' AS blank, ending <> '' AND again AS duplicate,
         ending <> '' AND NOT again AND ending NOT IN ('.', '!', '?') AS truncated,
         previous IS NOT NULL AND previous || ini NOT IN ('su', 'ua', 'au') AS illegal
  FROM marked),
steps AS (
  SELECT *, blank OR duplicate AS must_go, CASE WHEN truncated THEN {UNFINISHED} ELSE 0 END AS extra FROM turns),
counted AS (
  SELECT g, count(*) AS rows, coalesce(max(turn) - min(turn) + 1 - count(DISTINCT turn), 0)::BIGINT AS gaps,
         count_if(blank)::BIGINT AS blank, count_if(duplicate)::BIGINT AS duplicate,
         count_if(truncated)::BIGINT AS truncated, count_if(illegal)::BIGINT AS illegal
  FROM steps GROUP BY g),
start AS (SELECT {{'c': 0::BIGINT, 'e': '', 'o': []::VARCHAR[]}} AS z),
begun AS (SELECT z, {inserted("z", "user")} AS u FROM start),
walk AS (
  SELECT g, 0::BIGINT AS i, z, CASE WHEN false THEN z END AS s, u, {inserted("u", "assistant")} AS a
  FROM begun, (SELECT DISTINCT g FROM source)
  UNION ALL
  SELECT g, i, z, s, u, list_min([a, {inserted("u", "assistant")}]) AS a
  FROM (
    SELECT g, i, z, s, a, list_min([u, {inserted("z", "user")}, {inserted("s", "user")}, {inserted("a", "user")}]) AS u
    FROM (
      SELECT g, t.i, {deleted("z")} AS z, list_min([{deleted("s")}, {kept("z", "s")}]) AS s,
             list_min([{deleted("u")}, {to_user}]) AS u,
             list_min([{deleted("a")}, {kept("u", "a")}, {changed("u", "assistant")}]) AS a
      FROM (SELECT g, i + 1 AS i, z, s, u, a FROM walk) w JOIN steps t USING (g, i)))),
ended AS (SELECT g, i, list_min([z, a]) AS best FROM walk),
every AS (SELECT DISTINCT g, conv_id FROM source)
SELECT conv_id, coalesce(gaps, 0) AS gaps, coalesce(blank, 0) AS blank, coalesce(duplicate, 0) AS duplicate,
       coalesce(truncated, 0) AS truncated, coalesce(illegal, 0) AS illegal, best.c AS cost, best.e AS audit,
       sha256(array_to_string(best.o, chr(10))) AS repaired_sha256
FROM every LEFT JOIN counted USING (g) JOIN ended e USING (g) WHERE e.i = coalesce(rows, 0)"""


def oracle_sql() -> dict[str, str]:
    return {
        "op3_line_dedup": line_dedup(),
        "op6_suffix_dedup": suffix_dedup(),
        "op7_decontaminate": decontaminate(),
        "op11_exact_dedup": exact_dedup(),
        "op12_conversation_repair": conversation_repair(),
        "op13_collocations": collocations(),
    }
