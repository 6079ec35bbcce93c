"""SQL of the queries that SQL can express."""

#: ``crc_table.t``: the 256 steps of the CRC-32 polynomial, by its rule.
CRC_TABLE = """
crc_steps(b, k, v) AS (
  SELECT range, 0, range FROM range(256)
  UNION ALL
  SELECT b, k + 1, CASE WHEN v & 1 = 1 THEN xor(v >> 1, 3988292384) ELSE v >> 1 END FROM crc_steps WHERE k < 8
),
crc_table AS (SELECT list(v ORDER BY b) AS t FROM crc_steps WHERE k = 8)
"""


def crc32(text: str) -> str:
    """CRC-32 of an ASCII string, where ``crc_table`` is joined."""
    codes = f"list_transform(string_split({text}, ''), lambda c: CAST(ascii(c) AS BIGINT))"
    fold = f"list_reduce({codes}, lambda a, x: xor(a >> 8, t[CAST(xor(a, x) & 255 AS BIGINT) + 1]), CAST(4294967295 AS BIGINT))"
    return f"xor({fold}, 4294967295)"


def _field(name: str) -> str:
    value = f"CAST({name} AS VARCHAR)"
    return f"coalesce(octet_length(encode({value}))::VARCHAR || ':' || {value}, '-')"


def _leaf(text: str) -> str:
    return f"sha256({' || '.join([*map(_field, ('doc_id', 'source', 'lang', 'n_chars')), _field(text)])})"


def _tree(name: str, leaves: str, part: str, levels: int) -> str:
    """CTEs ``{name}0`` ... of the levels and ``{name}``: each leaf's root and joined siblings, level by level."""
    out = [f"{name}0 AS (SELECT {part} AS part, i, h, count(*) OVER (PARTITION BY {part}) AS n FROM {leaves})"]
    for k in range(levels):
        out.append(
            f"{name}{k + 1} AS (SELECT part, i // 8 AS i, sha256(string_agg(h, '' ORDER BY i)) AS h, (any_value(n) + 7) // 8 AS n"
            f" FROM {name}{k} WHERE n > 1 GROUP BY part, i // 8)"
        )
        out.append(
            f"{name}s{k} AS (SELECT a.part, a.i, coalesce(string_agg(b.h, '' ORDER BY b.i) FILTER (b.i < a.i), '') AS l,"
            f" coalesce(string_agg(b.h, '' ORDER BY b.i) FILTER (b.i > a.i), '') AS r"
            f" FROM {name}{k} a JOIN {name}{k} b ON a.part = b.part AND a.i // 8 = b.i // 8 WHERE a.n > 1 GROUP BY a.part, a.i)"
        )
    joins = " ".join(
        f"LEFT JOIN {name}s{k} ON {name}s{k}.part = x.part AND {name}s{k}.i = x.i // {8 ** k}" for k in range(levels)
    )
    roots = " UNION ALL ".join(f"SELECT part, h FROM {name}{k} WHERE n = 1" for k in range(levels + 1))
    sides = ", ".join(f"{name}s{k}.l AS l{k}, {name}s{k}.r AS r{k}" for k in range(levels))
    out.append(
        f"{name} AS (SELECT x.part, x.i, x.h, roots.h AS root, {sides} FROM {name}0 x JOIN ({roots}) roots ON roots.part = x.part {joins})"
    )
    return ",\n".join(out)


def _joined(alias: str, levels: int) -> str:
    return " || ".join(f"coalesce({alias}.l{k} || {alias}.r{k}, '')" for k in range(levels))


def _merkle(levels: int = 7, top: int = 3) -> str:
    """For at most 8 ** ``levels`` rows a language and 8 ** ``top`` languages."""
    steps = []
    for alias, n in (("g", levels), ("u", top)):
        for k in range(n):
            steps.append((f"{alias}.l{k}", f"{alias}.r{k}"))
    # One CTE a step: nested, the text would double with each of them.
    chain, last = [], "f0"
    chain.append(f"f0 AS (SELECT base.*, g.root AS subroot, u.root AS root, {_joined('g', levels)} || {_joined('u', top)} AS proof,"
                 f" base.tampered AS fold, " + ", ".join(f"{l} AS sl{k}, {r} AS sr{k}" for k, (l, r) in enumerate(steps))
                 + " FROM base JOIN g ON g.part = base.part AND g.i = base.i JOIN subroots ON subroots.h = g.root AND subroots.part = g.part"
                 + " JOIN u ON u.i = subroots.i)")
    for k in range(len(steps)):
        chain.append(f"f{k + 1} AS (SELECT * REPLACE (CASE WHEN sl{k} IS NULL THEN fold ELSE sha256(sl{k} || fold || sr{k}) END AS fold) FROM f{k})")
        last = f"f{k + 1}"
    low = "translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"
    return f"""
WITH RECURSIVE {CRC_TABLE.strip()},
leaves AS (
  SELECT doc_id, coalesce('=' || lang, '-') AS part, {_leaf('text')} AS h,
         CASE WHEN {crc32('CAST(doc_id AS VARCHAR)')} % 3 = 0 THEN {_leaf(low)} ELSE {_leaf('text')} END AS tampered
  FROM documents, crc_table
),
base AS MATERIALIZED (
  SELECT *, row_number() OVER (PARTITION BY part ORDER BY doc_id NULLS FIRST, h) - 1 AS i FROM leaves
),
{_tree('g', 'base', 'part', levels)},
subroots AS (SELECT part, root AS h, row_number() OVER (ORDER BY encode(part)) - 1 AS i FROM (SELECT DISTINCT part, root FROM g)),
{_tree('u', 'subroots', "''", top)},
{(","+chr(10)).join(chain)}
SELECT doc_id, h AS leaf, subroot, root, sha256(proof) AS proof_sha256, fold AS folded_root, fold = root AS verified FROM {last}
"""


MERKLE = _merkle()


def _edit(found: str, cost: str, letter: str) -> str:
    """An audit with its cost before it, as text that sorts by cost, then audit."""
    return f"lpad(CAST(CAST(left({found}, 9) AS BIGINT) + {cost} AS VARCHAR), 9, '0') || substr({found}, 10) || '{letter}'"


def _conversations() -> str:
    put = {s: _edit(s, "5", "I") for s in "esua"}
    user = {s: f"CASE WHEN NOT gone THEN CASE WHEN initial = 'u' THEN {_edit(s, 'stay', 'K')} ELSE {_edit(s, 'stay + 1', 'R')} END END" for s in "esa"}
    assistant = f"CASE WHEN NOT gone THEN CASE WHEN initial = 'a' THEN {_edit('u', 'stay', 'K')} ELSE {_edit('u', 'stay + 1', 'R')} END END"
    system = f"CASE WHEN NOT gone AND initial = 's' THEN {_edit('e', 'stay', 'K')} END"
    # Each turn comes after the turns inserted before it.
    inserted = f"SELECT conv_id, pos, e, s, least(u, {put['e']}, {put['s']}, {put['a']}) AS u, a FROM dp"
    inserted = f"SELECT conv_id, pos, e, s, u, least(a, {put['u']}) AS a FROM ({inserted})"
    return f"""
WITH RECURSIVE {CRC_TABLE.strip()},
raw AS (
  SELECT conv_id, turn, coalesce(role, ' ') AS role, coalesce(text, ' ') AS text,
         {crc32("coalesce(CAST(conv_id AS VARCHAR), ' ') || ':' || coalesce(CAST(turn AS VARCHAR), ' ')")} % 20 AS kind
  FROM conversations, crc_table
),
copies AS (SELECT *, unnest(range(CASE kind WHEN 0 THEN 0 WHEN 3 THEN 2 ELSE 1 END)) AS copy FROM raw),
turns AS (
  SELECT conv_id, turn, CASE WHEN kind = 4 THEN 'user' ELSE role END AS role,
         CASE kind WHEN 1 THEN '' WHEN 2 THEN regexp_replace(text, '[.!?]', '', 'g') ELSE text END AS text,
         row_number() OVER (PARTITION BY conv_id ORDER BY turn NULLS FIRST, role, sha256(text), copy) AS pos
  FROM copies
),
judged AS (
  SELECT *, left(role, 1) AS initial, CASE
    WHEN NOT regexp_matches(text, '[^\\x20\\x09-\\x0D]') THEN 'b'
    WHEN row_number() OVER (PARTITION BY conv_id, role, text ORDER BY pos) > 1 THEN 'd'
    WHEN NOT regexp_matches(text, '[.!?][\\x20\\x09-\\x0D]*\\z') THEN 't' ELSE '' END AS fault
  FROM turns
),
rows_ AS MATERIALIZED (
  SELECT *, fault IN ('b', 'd') AS gone, CASE WHEN fault = 't' THEN 5 ELSE 0 END AS stay,
         lag(initial) OVER (PARTITION BY conv_id ORDER BY pos) || initial AS pair FROM judged
),
ids AS MATERIALIZED (SELECT DISTINCT conv_id FROM conversations),
facts AS (
  SELECT ids.conv_id, coalesce(max(turn) - min(turn) + 1 - count(DISTINCT turn), 0) AS gaps,
         count(*) FILTER (fault = 'b') AS blank, count(*) FILTER (fault = 'd') AS duplicate, count(*) FILTER (fault = 't') AS truncated,
         count(*) FILTER (pair NOT IN ('su', 'ua', 'au')) AS illegal, count(pos) AS n
  FROM ids LEFT JOIN rows_ ON rows_.conv_id IS NOT DISTINCT FROM ids.conv_id GROUP BY ids.conv_id
),
dp(conv_id, pos, e, s, u, a) AS (
  SELECT conv_id, CAST(0 AS BIGINT), '000000000', CAST(NULL AS VARCHAR), CAST(NULL AS VARCHAR), CAST(NULL AS VARCHAR) FROM ids
  UNION ALL
  SELECT x.conv_id, r.pos, {_edit("e", "2", "D")}, least({_edit("s", "2", "D")}, {system}),
         least({_edit("u", "2", "D")}, {user["e"]}, {user["s"]}, {user["a"]}), least({_edit("a", "2", "D")}, {assistant})
  FROM ({inserted}) x JOIN rows_ r ON r.conv_id IS NOT DISTINCT FROM x.conv_id AND r.pos = x.pos + 1
),
ended AS (
  SELECT f.*, least(e, a) AS best FROM ({inserted}) x JOIN facts f ON f.conv_id IS NOT DISTINCT FROM x.conv_id AND f.n = x.pos
),
audits AS (SELECT * EXCLUDE (best), CAST(left(best, 9) AS BIGINT) AS cost, substr(best, 10) AS audit FROM ended),
letters AS (SELECT conv_id, unnest(range(1, length(audit) + 1)) AS k, audit FROM audits),
edits AS (
  SELECT conv_id, k, audit[k] AS letter, count(*) FILTER (audit[k] <> 'I') OVER w AS pos,
         count(*) FILTER (audit[k] <> 'D') OVER w AS out
  FROM letters WINDOW w AS (PARTITION BY conv_id ORDER BY k)
),
placed AS (
  SELECT d.*, r.role, r.text,
         bool_or(d.out = 1 AND letter = 'K' AND r.initial = 's') OVER (PARTITION BY d.conv_id) AS led
  FROM edits d LEFT JOIN rows_ r ON r.conv_id IS NOT DISTINCT FROM d.conv_id AND r.pos = d.pos AND letter <> 'I'
  WHERE letter <> 'D'
),
repaired AS (
  SELECT conv_id, string_agg(
    CASE WHEN letter = 'K' THEN role WHEN (out - CASE WHEN led THEN 1 ELSE 0 END) % 2 = 1 THEN 'user' ELSE 'assistant' END
    || ':' || CASE WHEN letter = 'I' THEN '' ELSE text END, chr(10) ORDER BY k) AS whole
  FROM placed GROUP BY conv_id
)
SELECT a.conv_id, gaps, blank, duplicate, truncated, illegal, cost, audit, sha256(coalesce(whole, '')) AS repaired_sha256
FROM audits a LEFT JOIN repaired p ON p.conv_id IS NOT DISTINCT FROM a.conv_id
"""


CONVERSATIONS = _conversations()


#: All pairs that share a shingle, links by exact set sizes, components by the least document reached.
NEAR_DUPLICATES = r"""
WITH RECURSIVE w AS (
  SELECT doc_id, coalesce(regexp_extract_all(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x20\x09-\x0D]+'), []) AS words
  FROM documents
),
s AS (
  SELECT doc_id, CASE WHEN len(words) >= 2 THEN list_distinct(list_transform(range(1, len(words)), lambda i: words[i] || ' ' || words[i + 1]))
    ELSE words END AS shingles FROM w
),
sets AS (
  SELECT list_sort(shingles) AS shingles, min(doc_id) AS node, len(any_value(shingles)) AS n FROM s WHERE len(shingles) > 0 GROUP BY 1
),
e AS (SELECT node, n, unnest(shingles) AS shingle FROM sets),
pairs AS (
  SELECT a.node AS x, b.node AS y FROM e a JOIN e b USING (shingle)
  WHERE a.node < b.node AND 100 * least(a.n, b.n) >= 80 * greatest(a.n, b.n)
  GROUP BY a.node, b.node, a.n, b.n HAVING 100 * count(*) >= 80 * (a.n + b.n - count(*))
),
links AS (SELECT x, y FROM pairs UNION ALL SELECT y, x FROM pairs),
reach AS (
  SELECT node AS doc, node AS least FROM sets
  UNION
  SELECT l.y, r.least FROM reach r JOIN links l ON l.x = r.doc WHERE r.least < l.y
),
component AS (SELECT doc AS node, min(least) AS component_id FROM reach GROUP BY doc)
SELECT s.doc_id, len(s.shingles)::BIGINT AS n_shingles, coalesce(c.component_id, s.doc_id) AS component_id,
  s.doc_id = coalesce(c.component_id, s.doc_id) AS kept
FROM s LEFT JOIN sets t ON t.shingles = list_sort(s.shingles) LEFT JOIN component c ON c.node = t.node
"""
