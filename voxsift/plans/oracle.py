"""DuckDB SQL twins of the registered queries (the correctness oracle).

Each SQL text runs on DuckDB with the provided tables registered as views
and must return the same rows, column names and types as the Spark query
of the same key.  The snippets below spell the Spark expressions of
``voxsift.functions`` in DuckDB SQL; they are written independently of the
Spark code path (brute-force joins, recursive CTEs) so they check it.
"""

from __future__ import annotations

from voxsift.functions.jsstr import JS_WHITESPACE_CLASS as WS
from voxsift.functions.text import SENTENCE_PATTERN, TAG_PATTERN, TOKEN_PATTERN
from voxsift.operators.classify import (CATEGORY_RULES, RELEVANCE_RULES,
                                        RELEVANCE_THRESHOLD)
from voxsift.operators.issue_profile import PRIOR, RELEVANCE as RELEVANCE_SHARE
from voxsift.operators.model import LOCAL_MODEL_MIN_TOKENS, RELEVANCE_TEMPLATE
from voxsift.operators.tickets import SOCIAL_HELP, STORE_HELP
from voxsift.sources.tables import (DEFAULT_OWNER_ID, DEFAULT_PART_ID, ROUTES,
                                    SEARCH_FROM, SOCIAL_DEFAULT_ARGS, STORE_DEFAULT_ARGS,
                                    TAG_NAMES)


def lit(s: str) -> str:
    return "'" + s.replace("'", "''") + "'"


def trim_js(x: str) -> str:
    return f"regexp_replace({x}, '^{WS}+|{WS}+$', '', 'g')"


def parse_int(x: str) -> str:
    s = f"regexp_replace({x}, '^{WS}+', '')"
    hexd = f"regexp_extract({s}, '^[+-]?0[xX]([0-9a-fA-F]+)', 1)"
    decd = f"regexp_extract({s}, '^[+-]?([0-9]+)', 1)"
    return (f"(CAST((CASE WHEN regexp_matches({s}, '^[+-]?0[xX]') "
            f"THEN (CASE WHEN {hexd} <> '' THEN TRY_CAST('0x' || {hexd} AS BIGINT) END) "
            f"ELSE (CASE WHEN {decd} <> '' THEN TRY_CAST({decd} AS BIGINT) END) END) "
            f"* (CASE WHEN substr({s}, 1, 1) = '-' THEN -1 ELSE 1 END) AS BIGINT))")


def u16(x: str) -> str:
    return f"(length({x}) + length(regexp_replace({x}, '[^\\x{{10000}}-\\x{{10FFFF}}]', '', 'g')))"


def longer(x: str, n: int) -> str:
    return f"coalesce({u16(x)} > {n}, false)"


def toks(x: str) -> str:
    return f"regexp_extract_all(lower({x}), '{TOKEN_PATTERN}')"


def norm(x: str) -> str:
    return f"(CASE WHEN len({toks(x)}) > 0 THEN array_to_string({toks(x)}, ' ') ELSE {x} END)"


def sents(x: str) -> str:
    return (f"list_filter(list_transform(regexp_extract_all({x}, '{SENTENCE_PATTERN}'), "
            f"lambda s: trim(s)), lambda s: s <> '')")


def strip_fences(x: str) -> str:
    return f"regexp_replace({x}, '^\\s*```(?:json)?\\s*|\\s*```\\s*$', '', 'g')"


def jtype(x: str, field: str) -> str:
    t = f"json_type({x}, '$.{field}')"
    return (f"(CASE WHEN json_valid({x}) THEN (CASE WHEN {t} IS NULL THEN NULL "
            f"WHEN {t} = 'VARCHAR' THEN 'string' WHEN {t} = 'BOOLEAN' THEN 'boolean' "
            f"WHEN {t} = 'NULL' THEN 'null' WHEN {t} = 'OBJECT' THEN 'object' "
            f"WHEN {t} = 'ARRAY' THEN 'array' ELSE 'number' END) END)")


def jtext(x: str, field: str) -> str:
    return f"(CASE WHEN json_valid({x}) THEN json_extract_string({x}, '$.{field}') END)"


def strict_true(x: str, field: str) -> str:
    return f"coalesce({jtype(x, field)} = 'string' AND {jtext(x, field)} = 'true', false)"


def keep(x: str, field: str = "relevance") -> str:
    return f"({jtype(x, field)} IS NULL OR {strict_true(x, field)})"


def sha(*parts: str) -> str:
    return "sha256(" + " || ':' || ".join(parts) + ")"


# --- shared CTEs -----------------------------------------------------------

REVIEWS = """reviews AS (
  SELECT d.doc_id AS review_id, d.source AS app_id, d.text AS text, d.lang AS language,
         CAST(floor(e.value) AS BIGINT) AS votes, e.ts AS created_at,
         'u' || CAST(e.user_id AS VARCHAR) AS username,
         'https://example.com/u' || CAST(e.user_id AS VARCHAR) || '/status/'
           || CAST(d.doc_id AS VARCHAR) AS url,
         CASE WHEN d.doc_id % 2 = 0 THEN 'store' ELSE 'social' END AS channel
  FROM documents d JOIN events e ON e.event_id = d.doc_id)"""

COMMAND_EVENTS = f"""cmd_src AS (
  SELECT event_id AS command_id, event_type, ts AS issued_at,
         json_extract_string(props, '$.k') AS k FROM events),
cmd_k AS (SELECT *, {parse_int('k')} AS kn FROM cmd_src),
cmd_a AS (SELECT *, 'src' || CAST(kn % 20 AS VARCHAR) AS app FROM cmd_k),
command_events AS (
  SELECT command_id, issued_at,
    CASE WHEN command_id % 2 = 0 THEN 'playstore_reviews_process'
         ELSE 'twitter_reviews_process' END AS command,
    CASE WHEN command_id % 2 = 0 THEN
      CASE WHEN event_type = 'view' THEN k
           WHEN event_type = 'click' THEN ' ' || k || 'abc' || chr(10)
           WHEN event_type = 'signup' THEN k || '.7'
           WHEN event_type = 'purchase' THEN '0x' || hex(kn)
           WHEN kn % 10 = 0 THEN ' help' || chr(65279)
           WHEN kn % 10 = 1 THEN '  ' || chr(10)
           WHEN kn % 10 = 2 THEN 'abc'
           ELSE CAST(kn * 3 AS VARCHAR) END
    ELSE
      CASE WHEN event_type = 'view' THEN 'search ' || app || ' ' || k
           WHEN event_type = 'click' THEN 'hashtag ' || app || ' ' || k
           WHEN event_type = 'signup' THEN 'search ' || app || ' ' || k || ' extra'
           WHEN event_type = 'purchase' THEN 'trend ' || app || ' ' || k
           WHEN kn % 10 = 0 THEN 'help'
           WHEN kn % 10 = 1 THEN ''
           WHEN kn % 10 = 2 THEN 'search  ' || app || ' ' || k
           ELSE 'search ' || app || ' ' || CAST(kn * 3 AS VARCHAR) END
    END AS parameters
  FROM cmd_a)"""


def parsed_cte(source: str = "command_events") -> str:
    store = "'playstore_reviews_process'"
    n = parse_int("CASE WHEN is_store THEN eff ELSE pieces[3] END")
    return f"""p1 AS (SELECT *, {trim_js('parameters')} AS trimmed FROM {source}),
p2 AS (SELECT *, command = {store} AS is_store, trimmed = 'help' AS is_help,
         CASE WHEN trimmed = '' THEN CASE WHEN command = {store} THEN {lit(STORE_DEFAULT_ARGS)}
              ELSE {lit(SOCIAL_DEFAULT_ARGS)} END ELSE trimmed END AS eff FROM p1),
p3 AS (SELECT *, string_split(eff, ' ')[1:3] AS pieces FROM p2),
p4 AS (SELECT *, CASE WHEN is_store THEN NULL ELSE pieces[1] END AS mode0,
         CASE WHEN is_store THEN NULL ELSE pieces[2] END AS term0, {n} AS n FROM p3),
p5 AS (SELECT *, CASE WHEN is_help THEN 'help' WHEN n IS NULL THEN 'reject_not_integer'
         WHEN NOT is_store AND NOT (mode0 IN ('hashtag', 'search')) THEN 'reject_unknown_mode'
         WHEN n > 100 THEN 'warn_over_100' WHEN n <= 0 THEN 'warn_non_positive'
         ELSE 'ok' END AS status FROM p4),
parsed AS (SELECT command_id, command, parameters, issued_at, trimmed,
    CASE WHEN is_help THEN NULL ELSE mode0 END AS mode,
    CASE WHEN is_help THEN NULL ELSE term0 END AS term,
    CASE WHEN is_help THEN NULL ELSE n END AS requested, status,
    CAST(CASE WHEN status IN ('ok', 'warn_over_100') THEN n
              WHEN status = 'warn_non_positive' THEN 0 END AS BIGINT) AS fetch_n
  FROM p5)"""


ROUTES_CTE = "routes(source, event_type, function) AS (VALUES " + ", ".join(
    f"({lit(a)}, {lit(b)}, {lit(c)})" for a, b, c in ROUTES) + ")"

CONFIG = f"""cfg_src AS (SELECT DISTINCT source FROM documents),
cfg_n AS (SELECT source, TRY_CAST(regexp_extract(source, '([0-9]+)$', 1) AS INTEGER) AS num
          FROM cfg_src),
config AS (SELECT source AS app_id,
    CASE WHEN num % 10 = 7 THEN '' ELSE 'App ' || upper(source) END AS app_name,
    CASE WHEN num % 3 = 0 THEN NULL ELSE 'part/' || CAST(num AS VARCHAR) END AS default_part_id,
    CASE WHEN num % 4 = 0 THEN NULL ELSE 'owner/' || CAST(num AS VARCHAR) END AS default_owner_id
  FROM cfg_n),
resolved AS (SELECT app_id, coalesce(app_name, '') AS app_name,
    coalesce(nullif(default_part_id, ''), {lit(DEFAULT_PART_ID)}) AS part_id,
    coalesce(nullif(default_owner_id, ''), {lit(DEFAULT_OWNER_ID)}) AS owner_id,
    nullif(concat_ws(',', CASE WHEN coalesce(app_name, '') = '' THEN 'app_name' END,
                     CASE WHEN coalesce(app_id, '') = '' THEN 'app_id' END), '') AS config_error
  FROM config)"""

SOURCES = """sources AS (
  SELECT 'store' AS source, review_id, app_id, text, language, votes, created_at, url,
         'Ticket created from Playstore review ' || url AS title,
         'Ticket created from Playstore review ' || url || chr(10) || chr(10) || text AS ticket_text
  FROM reviews WHERE channel = 'store'
  UNION ALL
  SELECT 'social', review_id, app_id, text, language, votes, created_at,
         'https://twitter.com/' || username || '/status/' || CAST(review_id AS VARCHAR),
         'Ticket created from Twitter review ' || CAST(review_id AS VARCHAR),
         'Ticket created from Twitter review ' || CAST(review_id AS VARCHAR) || chr(10) || chr(10)
           || text
  FROM reviews WHERE channel = 'social')"""


def _rules_values(rules) -> str:
    return "(VALUES " + ", ".join(
        "(" + ", ".join(lit(v) if isinstance(v, str) else str(v) for v in r) + ")"
        for r in rules) + ")"


def _label_order() -> list[str]:
    labels = {lbl for lbl, _, _ in CATEGORY_RULES}
    return [t for t in TAG_NAMES if t in labels] + sorted(labels - set(TAG_NAMES))


def category_cte(src: str) -> str:
    """``cat(review_id, category, category_score, tag_id)`` over ``src``."""
    order = ", ".join(f"({lit(lbl)}, {i})" for i, lbl in enumerate(_label_order()))
    tags = ", ".join(lit(t) for t in TAG_NAMES)
    return f"""crules(label, term, weight) AS {_rules_values(CATEGORY_RULES)},
lorder(label, o) AS (VALUES {order}),
ctok AS (SELECT DISTINCT review_id, tok FROM
          (SELECT review_id, unnest({toks('text')}) AS tok FROM {src})),
lscore AS (SELECT t.review_id, c.label, sum(c.weight) AS score FROM ctok t
           JOIN crules c ON t.tok = c.term GROUP BY 1, 2),
lbest AS (SELECT review_id, label, score FROM (
           SELECT l.*, row_number() OVER (PARTITION BY l.review_id ORDER BY l.score DESC, o.o)
             AS rn FROM lscore l JOIN lorder o USING (label)) WHERE rn = 1),
cat AS (SELECT s.review_id,
    CASE WHEN coalesce(b.score, 0) > 0 AND b.label IN ({tags}) THEN b.label
         ELSE 'failed_to_infer_category' END AS category,
    CAST(coalesce(b.score, 0) AS BIGINT) AS category_score
  FROM {src} s LEFT JOIN lbest b USING (review_id)),
catt AS (SELECT *, 'tag:' || category AS tag_id FROM cat)"""


RELEVANCE = f"""rrules(term, weight) AS {_rules_values(RELEVANCE_RULES)},
rtok AS (SELECT DISTINCT review_id, tok FROM
          (SELECT review_id, unnest({toks('text')}) AS tok FROM reviews)),
rscore AS (SELECT t.review_id, sum(r.weight) AS s FROM rtok t JOIN rrules r ON t.tok = r.term
           GROUP BY 1),
rel AS (SELECT r.review_id, CAST(coalesce(s.s, 0) AS BIGINT) AS relevance_score,
               coalesce(s.s, 0) >= {RELEVANCE_THRESHOLD} AS relevant
        FROM reviews r LEFT JOIN rscore s USING (review_id))"""


def summary_cte(src: str, name: str, title_terms: int, summary_sentences: int, corpus: str = "") -> str:
    """``{name}(review_id, title, summary)`` over ``src(review_id, text)``, with
    the document frequencies of ``src``, or of the texts of ``corpus``."""
    df = (f"(SELECT unnest(list_distinct({toks('text')})) AS tok FROM {corpus})" if corpus else f"{name}_tf")
    return f"""{name}_tl AS (SELECT review_id, {toks('text')} AS tl FROM {src}),
{name}_tp AS (SELECT review_id, unnest(tl) AS tok, generate_subscripts(tl, 1) AS pos
              FROM {name}_tl),
{name}_tf AS (SELECT review_id, tok, count(*) AS tf, min(pos) AS first_pos FROM {name}_tp
              GROUP BY 1, 2),
{name}_df AS (SELECT tok, count(*) AS df FROM {df} GROUP BY 1),
{name}_n AS (SELECT CAST(count(*) AS DOUBLE) AS n FROM {corpus or src}),
{name}_w AS (SELECT f.review_id, f.tok, f.first_pos,
    f.tf * CAST(floor(1000000 * ln(n.n / CAST(d.df AS DOUBLE))) AS BIGINT) AS weight
  FROM {name}_tf f JOIN {name}_df d USING (tok) CROSS JOIN {name}_n n),
{name}_title AS (SELECT review_id, string_agg(tok, ' ' ORDER BY first_pos) AS title FROM (
    SELECT *, row_number() OVER (PARTITION BY review_id ORDER BY weight DESC, first_pos) AS rn
    FROM {name}_w) WHERE rn <= {title_terms} GROUP BY 1),
{name}_sl AS (SELECT review_id, {sents('text')} AS sl FROM {src}),
{name}_s AS (SELECT review_id, unnest(sl) AS sentence, generate_subscripts(sl, 1) AS s_pos
             FROM {name}_sl),
{name}_st AS (SELECT DISTINCT review_id, s_pos, tok FROM
    (SELECT review_id, s_pos, unnest({toks('sentence')}) AS tok FROM {name}_s)),
{name}_ss AS (SELECT st.review_id, st.s_pos, sum(w.weight) AS score FROM {name}_st st
    JOIN {name}_w w ON st.review_id = w.review_id AND st.tok = w.tok GROUP BY 1, 2),
{name}_best AS (SELECT review_id, string_agg(sentence, ' ' ORDER BY s_pos) AS summary FROM (
    SELECT s.*, row_number() OVER (PARTITION BY s.review_id
                                   ORDER BY coalesce(ss.score, 0) DESC, s.s_pos) AS rn
    FROM {name}_s s LEFT JOIN {name}_ss ss USING (review_id, s_pos))
  WHERE rn <= {summary_sentences} GROUP BY 1),
{name} AS (SELECT s.review_id, coalesce(t.title, '') AS title, coalesce(b.summary, '') AS summary
  FROM {src} s LEFT JOIN {name}_title t USING (review_id) LEFT JOIN {name}_best b USING (review_id))"""


TOPN = """top AS (SELECT *, app_id AS command_id,
    row_number() OVER (PARTITION BY app_id ORDER BY votes DESC, review_id) AS rank
  FROM reviews QUALIFY rank <= 10)"""

TAGGED_POSTS = """posts AS (SELECT review_id, app_id, language, votes, created_at,
    '@' || app_id || ' ' || text || ' #' || app_id AS text FROM reviews
  WHERE channel = 'social')"""


def search_cte(mode: str) -> str:
    sigil = "@" if mode == "search" else "#"
    pattern = TAG_PATTERN.replace("([@#])", "[" + sigil + "]")
    where = (f"WHERE language = 'en' AND created_at >= TIMESTAMP '{SEARCH_FROM}'"
             if mode == "search" else "")
    return f"""{TAGGED_POSTS},
tagged AS (SELECT DISTINCT review_id, votes, lower(m) AS term FROM
    (SELECT review_id, votes, unnest(regexp_extract_all(text, '{pattern}', 1)) AS m
     FROM posts {where})),
ranked AS (SELECT term, review_id,
    row_number() OVER (PARTITION BY term ORDER BY votes DESC, review_id) AS rank FROM tagged),
cmds AS (SELECT command_id, lower(term) AS term, fetch_n FROM parsed
         WHERE mode = '{mode}' AND fetch_n > 0),
offered AS (SELECT c.command_id, c.fetch_n, c.term, r.review_id, r.rank FROM cmds c
            JOIN ranked r ON c.term = r.term
            WHERE r.rank <= ceil(c.fetch_n / 20.0) * 20),
fetched AS (SELECT * FROM offered WHERE rank <= fetch_n)"""


JACCARD = """len(a.ts) > 0 AND len(b.ts) > 0
    AND 5 * len(a.ts) >= 4 * len(b.ts) AND 5 * len(b.ts) >= 4 * len(a.ts)
    AND 5 * len(list_intersect(a.ts, b.ts)) >= 4 * len(list_distinct(list_concat(a.ts, b.ts)))"""


def triage_cte() -> str:
    """``tix`` (flat tickets) and ``iss`` (issues) of the whole triage."""
    store = "'store'"
    return f"""{REVIEWS},
{SOURCES},
fb AS (SELECT *, app_id AS command_id FROM sources),
kept0 AS (SELECT * FROM fb WHERE {longer('text', 3)}),
{RELEVANCE},
kept AS (SELECT k.*, {norm('k.text')} AS nt FROM kept0 k JOIN rel r USING (review_id)
         WHERE r.relevant),
grp AS (SELECT command_id, nt, first(review_id ORDER BY votes DESC, review_id) AS leader_id,
           CAST(count(*) AS BIGINT) AS total_reviews, CAST(sum(votes) AS BIGINT) AS total_votes
        FROM kept GROUP BY 1, 2),
leaders AS (SELECT k.* FROM kept k JOIN grp g ON k.review_id = g.leader_id),
lsrc AS (SELECT review_id, text FROM leaders),
{summary_cte('lsrc', 'tsum', 5, 1)},
{category_cte('leaders')},
{CONFIG},
ok AS (SELECT l.*, c.category, c.tag_id, r.part_id, r.owner_id, s.title AS gen_title,
         s.summary
       FROM leaders l JOIN catt c USING (review_id) JOIN tsum s USING (review_id)
       LEFT JOIN resolved r USING (app_id) WHERE r.config_error IS NULL),
tix AS (SELECT o.command_id, o.review_id, o.source, o.url,
    {sha("'ticket'", 'o.command_id', 'CAST(o.review_id AS VARCHAR)')} AS ticket_id,
    o.gen_title AS title, o.tag_id AS tag_ids, o.summary || chr(10) || o.url AS body,
    o.owner_id AS owned_by, o.part_id AS applies_to_part,
    CASE WHEN o.category = 'positive_feedback' THEN 'blocker'
         WHEN o.category IN ('feature_request', 'question') THEN 'low'
         WHEN o.category IN ('negative_feedback', 'logistics_experience') THEN 'medium'
         ELSE 'high' END AS severity,
    o.category, g.total_reviews, g.total_votes
  FROM ok o JOIN grp g ON o.review_id = g.leader_id),
need AS (SELECT t.review_id, o.text FROM tix t JOIN ok o USING (review_id)
         WHERE t.severity <> 'blocker' AND t.source = {store}),
{summary_cte('need', 'isum', 3, 2)},
iss AS (SELECT t.command_id, t.review_id,
    {sha("'issue'", 't.command_id', 'CAST(t.review_id AS VARCHAR)')} AS issue_id, t.ticket_id,
    CASE WHEN t.source = {store} THEN i.title || 'Ticket ID:' || t.ticket_id ELSE t.title END
      AS title,
    CASE WHEN t.source = {store} THEN i.summary || chr(10) || t.url ELSE t.body END AS body,
    CASE WHEN t.severity = 'low' THEN 'p3' WHEN t.severity = 'medium' THEN 'p2' ELSE 'p1' END
      AS priority, t.category
  FROM tix t LEFT JOIN isum i USING (review_id) WHERE t.severity <> 'blocker')"""


def typical_cte() -> str:
    """``tiss``: the issues of ``triage_cte`` with texts typical of their category."""
    prior = float(PRIOR)

    def odds(count: str, size: str) -> str:
        return (f"CAST(floor(1000000 * ln(({count} + mass) / ({size} + {prior} + 1 - {count} - mass)))"
                f" AS BIGINT)")

    share = "(1000 * len(list_intersect(c.toks, p.toks))) // len(list_distinct(list_concat(c.toks, p.toks)))"
    return f"""p_in AS (SELECT category, tok, count(*) AS n_in FROM
    (SELECT category, unnest(list_distinct({toks('text')})) AS tok FROM ok) GROUP BY 1, 2),
p_all AS (SELECT tok, CAST(sum(n_in) AS BIGINT) AS n_all FROM p_in GROUP BY 1),
p_class AS (SELECT category, CAST(sum(n_in) AS BIGINT) AS n_class FROM p_in GROUP BY 1),
p_sum AS (SELECT CAST(sum(n_in) AS BIGINT) AS n_sum FROM p_in),
p_mass AS (SELECT *, {prior} * CAST(n_all AS DOUBLE) / CAST(n_sum AS DOUBLE) AS mass
  FROM p_in JOIN p_all USING (tok) JOIN p_class USING (category) CROSS JOIN p_sum),
p_odds AS (SELECT category, tok, {odds('n_in', 'n_class')}
    - {odds('(n_all - n_in)', '(n_sum - n_class)')} AS weight FROM p_mass),
pneed AS (SELECT t.review_id, t.category, o.text FROM tix t JOIN ok o USING (review_id)
  WHERE t.severity <> 'blocker' AND t.source = 'store'),
p_tl AS (SELECT review_id, category, {toks('text')} AS tl FROM pneed),
p_tp AS (SELECT review_id, category, unnest(tl) AS tok, generate_subscripts(tl, 1) AS pos FROM p_tl),
p_w AS (SELECT f.review_id, f.tok, f.first_pos, CAST(f.tf * o.weight AS BIGINT) AS weight FROM
    (SELECT review_id, category, tok, count(*) AS tf, min(pos) AS first_pos FROM p_tp GROUP BY 1, 2, 3) f
  JOIN p_odds o ON f.category = o.category AND f.tok = o.tok WHERE o.weight > 0),
p_title AS (SELECT review_id, string_agg(tok, ' ' ORDER BY first_pos) AS title FROM (
    SELECT *, row_number() OVER (PARTITION BY review_id ORDER BY weight DESC, first_pos) AS rn
    FROM p_w) WHERE rn <= 3 GROUP BY 1),
p_sl AS (SELECT review_id, {sents('text')} AS sl FROM pneed),
p_s AS (SELECT review_id, unnest(sl) AS sentence, generate_subscripts(sl, 1) AS s_pos FROM p_sl),
p_st AS (SELECT DISTINCT review_id, s_pos, tok FROM
    (SELECT review_id, s_pos, unnest({toks('sentence')}) AS tok FROM p_s)),
p_cand AS (SELECT st.review_id, st.s_pos, CAST(sum(w.weight) AS BIGINT) AS score, list(st.tok) AS toks
  FROM p_st st JOIN p_w w ON st.review_id = w.review_id AND st.tok = w.tok GROUP BY 1, 2),
p_rel AS (SELECT *, 1000 * score // max(score) OVER (PARTITION BY review_id) AS rel FROM p_cand),
p_one AS (SELECT * FROM p_rel
  QUALIFY row_number() OVER (PARTITION BY review_id ORDER BY rel DESC, s_pos) = 1),
p_two AS (SELECT c.review_id, c.s_pos FROM p_rel c JOIN p_one p
  ON c.review_id = p.review_id AND c.s_pos <> p.s_pos
  QUALIFY row_number() OVER (PARTITION BY c.review_id ORDER BY
    {RELEVANCE_SHARE} * c.rel - {1000 - RELEVANCE_SHARE} * ({share}) DESC, c.s_pos) = 1),
p_pick AS (SELECT s.review_id, s.s_pos, s.sentence,
    row_number() OVER (PARTITION BY s.review_id ORDER BY
      CASE WHEN o.s_pos IS NOT NULL THEN 1 WHEN t.s_pos IS NOT NULL THEN 2 ELSE 3 END, s.s_pos) AS rn
  FROM p_s s LEFT JOIN p_one o USING (review_id, s_pos) LEFT JOIN p_two t USING (review_id, s_pos)),
p_text AS (SELECT n.review_id, coalesce(t.title, '') AS title, coalesce(b.summary, '') AS summary
  FROM pneed n LEFT JOIN p_title t USING (review_id) LEFT JOIN (
    SELECT review_id, string_agg(sentence, ' ' ORDER BY s_pos) AS summary FROM p_pick WHERE rn <= 2
    GROUP BY 1) b USING (review_id)),
tiss AS (SELECT i.command_id, i.review_id, i.issue_id,
    CASE WHEN p.review_id IS NOT NULL THEN p.title || 'Ticket ID:' || t.ticket_id ELSE i.title END AS title,
    CASE WHEN p.review_id IS NOT NULL THEN p.summary || chr(10) || t.url ELSE i.body END AS body,
    i.priority, i.category
  FROM iss i JOIN tix t USING (review_id) LEFT JOIN p_text p USING (review_id))"""


def command_triage_cte() -> str:
    """``tix`` and ``iss`` of all commands: each list walked by the sequential
    rule, each command's counts taken from its own rows."""
    post = "CASE WHEN channel = 'social' THEN '@' || app_id || ' ' || text || ' #' || app_id ELSE text END AS text"
    tagged = lambda kind, sigil, where: f"""SELECT DISTINCT '{kind}:' || lower(m) AS list_key, review_id FROM
    (SELECT review_id, unnest(regexp_extract_all(text, '{TAG_PATTERN.replace("([@#])", "[" + sigil + "]")}', 1)) AS m
     FROM reviews WHERE channel = 'social' {where})"""  # noqa: E731
    english = f"AND language = 'en' AND created_at >= TIMESTAMP '{SEARCH_FROM}'"
    return f"""{REVIEWS.replace("reviews AS (", "reviews0 AS (", 1)},
reviews AS (SELECT * REPLACE ({post.removesuffix(" AS text")} AS text) FROM reviews0),
{SOURCES},
{COMMAND_EVENTS},
{parsed_cte()},
{CONFIG},
fetches AS (SELECT p.command_id, p.fetch_n, c.part_id, c.owner_id,
    CASE WHEN p.command = 'playstore_reviews_process' THEN 'store:' || a.app
         ELSE p.mode || ':' || lower(p.term) END AS list_key
  FROM parsed p JOIN cmd_a a USING (command_id) JOIN resolved c ON c.app_id = a.app
  WHERE p.fetch_n > 0 AND c.config_error IS NULL),
offers AS (SELECT 'store:' || app_id AS list_key, review_id FROM reviews WHERE channel = 'store'
  UNION ALL {tagged("search", "@", english)}
  UNION ALL {tagged("hashtag", "#", "")}),
ranked AS (SELECT o.list_key, s.*, row_number() OVER (PARTITION BY o.list_key
    ORDER BY s.votes DESC, s.review_id) AS rank FROM offers o JOIN sources s USING (review_id)),
{RELEVANCE},
r AS (SELECT k.list_key, k.review_id, k.rank, k.votes, {norm('k.text')} AS nt, list_distinct({toks('k.text')}) AS ts
      FROM ranked k JOIN rel USING (review_id)
      WHERE rel.relevant AND {longer('k.text', 3)}
        AND k.rank <= (SELECT max(fetch_n) FROM fetches f WHERE f.list_key = k.list_key)),
nodes AS (SELECT list_key, nt, min(rank) AS rank FROM r GROUP BY 1, 2),
nd AS (SELECT n.list_key, n.nt, r.review_id, r.ts, row_number() OVER (PARTITION BY n.list_key ORDER BY n.rank) AS rk
       FROM nodes n JOIN r ON r.list_key = n.list_key AND r.rank = n.rank),
edges AS (SELECT b.list_key, a.rk AS ark, b.rk AS brk FROM nd a JOIN nd b ON a.list_key = b.list_key AND a.rk < b.rk
  WHERE {JACCARD}),
nb AS (SELECT nd.list_key, nd.rk, list(e.ark) FILTER (WHERE e.ark IS NOT NULL) AS earlier
       FROM nd LEFT JOIN edges e ON e.list_key = nd.list_key AND e.brk = nd.rk GROUP BY 1, 2),
walk(list_key, rk, leaders) AS (
  SELECT DISTINCT list_key, CAST(0 AS BIGINT), CAST([] AS BIGINT[]) FROM nd
  UNION ALL SELECT w.list_key, nb.rk, CASE WHEN len(list_intersect(w.leaders,
      coalesce(nb.earlier, CAST([] AS BIGINT[])))) > 0 THEN w.leaders ELSE list_append(w.leaders, nb.rk) END
  FROM walk w JOIN nb ON nb.list_key = w.list_key AND nb.rk = w.rk + 1),
fin AS (SELECT list_key, arg_max(leaders, rk) AS leaders FROM walk GROUP BY 1),
nl AS (SELECT nb.list_key, nb.rk, CASE WHEN list_contains(f.leaders, nb.rk) THEN nb.rk
         ELSE list_min(list_intersect(f.leaders, nb.earlier)) END AS lrk
       FROM nb JOIN fin f USING (list_key)),
folds AS (SELECT r.list_key, r.review_id, r.rank, r.votes, l.review_id AS leader_id
  FROM r JOIN nd ON nd.list_key = r.list_key AND nd.nt = r.nt
  JOIN nl ON nl.list_key = nd.list_key AND nl.rk = nd.rk
  JOIN nd l ON l.list_key = nl.list_key AND l.rk = nl.lrk),
grp AS (SELECT f.command_id, any_value(f.part_id) AS part_id, any_value(f.owner_id) AS owner_id,
    d.leader_id AS review_id, CAST(count(*) AS BIGINT) AS total_reviews, CAST(sum(d.votes) AS BIGINT) AS total_votes
  FROM fetches f JOIN folds d ON d.list_key = f.list_key AND d.rank <= f.fetch_n GROUP BY f.command_id, d.leader_id),
corpus AS (SELECT review_id, ticket_text AS text FROM sources),
lead AS (SELECT * FROM corpus WHERE review_id IN (SELECT review_id FROM grp)),
{summary_cte('lead', 'tsum', 5, 1, 'corpus')},
{category_cte('lead')},
tix AS (SELECT g.command_id, g.review_id, s.source, s.url,
    {sha("'ticket'", 'CAST(g.command_id AS VARCHAR)', 'CAST(g.review_id AS VARCHAR)')} AS ticket_id,
    t.title, c.tag_id AS tag_ids, t.summary || chr(10) || s.url AS body,
    g.owner_id AS owned_by, g.part_id AS applies_to_part,
    CASE WHEN c.category = 'positive_feedback' THEN 'blocker'
         WHEN c.category IN ('feature_request', 'question') THEN 'low'
         WHEN c.category IN ('negative_feedback', 'logistics_experience') THEN 'medium'
         ELSE 'high' END AS severity,
    c.category, g.total_reviews, g.total_votes
  FROM grp g JOIN sources s USING (review_id) JOIN tsum t USING (review_id) JOIN catt c USING (review_id)),
need AS (SELECT DISTINCT l.review_id, l.text FROM lead l JOIN tix t USING (review_id)
         WHERE t.severity <> 'blocker' AND t.source = 'store'),
{summary_cte('need', 'isum', 3, 2, 'corpus')},
iss AS (SELECT t.command_id, t.review_id,
    {sha("'issue'", 'CAST(t.command_id AS VARCHAR)', 'CAST(t.review_id AS VARCHAR)')} AS issue_id, t.ticket_id,
    CASE WHEN t.source = 'store' THEN i.title || 'Ticket ID:' || t.ticket_id ELSE t.title END AS title,
    CASE WHEN t.source = 'store' THEN i.summary || chr(10) || t.url ELSE t.body END AS body,
    CASE WHEN t.severity = 'low' THEN 'p3' WHEN t.severity = 'medium' THEN 'p2' ELSE 'p1' END AS priority,
    t.category
  FROM tix t LEFT JOIN isum i USING (review_id) WHERE t.severity <> 'blocker')"""


def ticket_rows_cte() -> str:
    return f"""{REVIEWS},
{SOURCES},
src AS (SELECT *, app_id AS command_id FROM sources),
{category_cte('src')},
{CONFIG},
trows AS (SELECT s.command_id, s.review_id, s.source, s.created_at, c.category,
    {sha("'ticket'", 's.command_id', 'CAST(s.review_id AS VARCHAR)')} AS ticket_id,
    s.title, c.tag_id, s.text || chr(10) || s.url AS body, r.owner_id AS owned_by,
    r.part_id AS applies_to_part,
    CASE WHEN c.category = 'positive_feedback' THEN 'blocker'
         WHEN c.category IN ('feature_request', 'question') THEN 'low'
         WHEN c.category IN ('negative_feedback', 'logistics_experience') THEN 'medium'
         ELSE 'high' END AS severity
  FROM src s JOIN catt c USING (review_id) LEFT JOIN resolved r USING (app_id)
  WHERE r.config_error IS NULL),
trows2 AS (SELECT *, CASE WHEN severity = 'blocker' THEN NULL WHEN severity = 'low' THEN 'p3'
    WHEN severity = 'medium' THEN 'p2' ELSE 'p1' END AS priority,
    severity <> 'blocker' AS needs_issue FROM trows)"""


def _q(*ctes: str, body: str) -> str:
    return "WITH " + ",\n".join(ctes) + "\n" + body


def oracle_sql() -> dict[str, str]:
    q: dict[str, str] = {}
    q["topn_helpful"] = _q(REVIEWS, TOPN, body="""SELECT command_id, review_id, votes,
        CAST(rank AS BIGINT) AS rank FROM top""")
    q["noise_filter"] = _q(REVIEWS, body=f"""SELECT review_id,
        CAST({u16('text')} AS BIGINT) AS text_units, {longer('text', 20)} AS over_20
        FROM reviews WHERE {longer('text', 3)}""")
    q["command_parse"] = _q(COMMAND_EVENTS, parsed_cte(), body="""SELECT command_id, command,
        trimmed, mode, term, requested, status, fetch_n FROM parsed""")
    q["command_count_from_props"] = _q(
        """counts AS (SELECT event_id AS command_id, 'playstore_reviews_process' AS command,
           json_extract_string(props, '$.k') AS parameters, ts AS issued_at FROM events)""",
        parsed_cte("counts"),
        body="SELECT command_id, parameters, requested, status, fetch_n FROM parsed")
    q["route_events"] = _q(ROUTES_CTE, body="""SELECT e.event_id, e.event_type, r.function,
        CASE WHEN r.function IS NULL THEN 'rejected' ELSE 'routed' END AS route_status
        FROM events e LEFT JOIN (SELECT event_type, function FROM routes WHERE source = 'event') r
        ON e.event_type = r.event_type""")
    q["config_defaults"] = _q(REVIEWS, CONFIG, body="""SELECT r.review_id, r.app_id,
        c.app_name, c.part_id, c.owner_id, c.config_error
        FROM reviews r LEFT JOIN resolved c USING (app_id)""")
    q["union_sources"] = _q(REVIEWS, SOURCES, body="""SELECT source, review_id, app_id, url,
        votes, title, ticket_text FROM sources""")
    q["mention_search"] = _q(REVIEWS, COMMAND_EVENTS, parsed_cte(), search_cte("search"),
                             body="""SELECT command_id, review_id, CAST(rank AS BIGINT) AS rank
                             FROM fetched""")
    q["hashtag_search"] = _q(REVIEWS, COMMAND_EVENTS, parsed_cte(), search_cte("hashtag"),
                             body="""SELECT command_id, review_id, CAST(rank AS BIGINT) AS rank
                             FROM fetched""")
    before = "ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING"
    search_url = ("'https://social.example/search/search?query=%40' || term || "
                  f"'&section=top&language=en&start_date={SEARCH_FROM}'")
    hashtag_url = "'https://social.example/hashtag/hashtag?hashtag=%23' || term"
    for name, mode, request in (("page_log", "search", search_url), ("page_log_hashtag", "hashtag", hashtag_url)):
        q[name] = _q(REVIEWS, COMMAND_EVENTS, parsed_cte(), search_cte(mode), f"""pages AS (
        SELECT command_id, CAST(ceil(rank / 20) AS BIGINT) AS page_no, count(*) AS rows_in_page,
               max(fetch_n) AS fetch_n, max(term) AS term FROM fetched GROUP BY 1, 2),
        pl AS (SELECT *, coalesce(sum(rows_in_page) OVER (PARTITION BY command_id ORDER BY page_no
               {before}), 0) AS seen_before,
               sum(rows_in_page) OVER (PARTITION BY command_id ORDER BY page_no
               ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS seen_after FROM pages)""",
                       body=f"""SELECT command_id, page_no, CAST(rows_in_page AS BIGINT) AS rows_in_page,
        CAST(seen_before AS BIGINT) AS seen_before,
        CAST(least(20, fetch_n - seen_before) AS BIGINT) AS page_limit,
        CAST(seen_after AS BIGINT) AS seen_after,
        {request}
          || CASE WHEN page_no > 1 THEN '&continuation_token=' || CAST(command_id AS VARCHAR)
               || ':' || CAST(page_no AS VARCHAR) ELSE '' END
          || '&limit=' || CAST(least(20, fetch_n - seen_before) AS VARCHAR) AS request_url
        FROM pl""")
    q["page_explode"] = _q(REVIEWS, COMMAND_EVENTS, parsed_cte(), search_cte("search"), f"""pages AS (
        SELECT command_id, CAST(ceil(rank / 20) AS BIGINT) AS page_no, count(*) AS sz
        FROM offered GROUP BY 1, 2),
        wanted AS (SELECT DISTINCT command_id, fetch_n FROM offered),
        pw AS (SELECT p.*, w.fetch_n,
          coalesce(sum(sz) OVER (PARTITION BY p.command_id ORDER BY page_no {before}), 0)
            AS seen_before,
          coalesce(max(CASE WHEN sz <> 20 THEN 1 ELSE 0 END) OVER (PARTITION BY p.command_id
            ORDER BY page_no {before}), 0) AS short_before
          FROM pages p JOIN wanted w USING (command_id)),
        readp AS (SELECT * FROM pw WHERE short_before = 0 AND seen_before < fetch_n),
        prow AS (SELECT o.command_id, rp.page_no, rp.seen_before, rp.fetch_n, o.review_id,
                 o.rank - (rp.page_no - 1) * 20 - 1 AS pos0
          FROM offered o JOIN readp rp ON o.command_id = rp.command_id
           AND CAST(ceil(o.rank / 20) AS BIGINT) = rp.page_no)""",
                           body="""SELECT command_id, page_no, CAST(pos0 + 1 AS BIGINT) AS pos,
        review_id FROM prow WHERE seen_before + pos0 < fetch_n""")
    q["work_list_first"] = _q(triage_cte(), body="""SELECT ticket_id, review_id, title
        FROM tix ORDER BY ticket_id LIMIT 1""")
    rr, dr = strip_fences("relevance_reply"), strip_fences("duplicate_reply")
    replies = f"""lab AS (SELECT doc_id, quality, toxic,
        CASE WHEN quality = 1 THEN 'true' ELSE 'false' END AS q FROM labels),
      rep AS (SELECT doc_id,
        CASE doc_id % 6 WHEN 0 THEN '{{"relevance":"' || q || '","reason":"label"}}'
          WHEN 1 THEN '{{"relevance":' || q || '}}' WHEN 2 THEN '{{"relevance":null}}'
          WHEN 3 THEN '{{}}' WHEN 4 THEN 'not json'
          ELSE '```json' || chr(10) || '{{"relevance":"' || q || '"}}' || chr(10) || '```' END
          AS relevance_reply,
        CASE doc_id % 5 WHEN 0 THEN '{{"is_duplicate":"true","match_with":' || CAST(toxic AS VARCHAR) || '}}'
          WHEN 1 THEN '{{"is_duplicate":"true","match_with":"' || CAST(toxic + 1 AS VARCHAR) || '"}}'
          WHEN 2 THEN '{{"is_duplicate":"true","match_with":-1}}'
          WHEN 3 THEN '{{"is_duplicate":true,"match_with":0}}'
          ELSE '{{"is_duplicate":"false","match_with":-1}}' END AS duplicate_reply FROM lab),
      pr AS (SELECT doc_id, {rr} AS rr, {dr} AS dr FROM rep)"""
    q["reply_parse"] = _q(replies,
                          body=f"""SELECT doc_id, {jtype('rr', 'relevance')} AS relevance_type,
        {keep('rr')} AS keep, {strict_true('dr', 'is_duplicate')} AS is_dup,
        {parse_int(jtext('dr', 'match_with'))} AS match_with FROM pr""")
    bad_index = f"({strict_true('dr', 'is_duplicate')} AND coalesce({parse_int(jtext('dr', 'match_with'))}, -1) < 0)"

    def fault(x: str, *needs: tuple[str, list[str]]) -> str:
        out = f"CASE WHEN NOT json_valid({x}) THEN 'not JSON' WHEN json_type({x}) <> 'OBJECT' THEN 'not an object'"
        for name, types in needs:
            kind = jtype(x, name)
            out += (f" WHEN {kind} IS NULL THEN '{name} missing'"
                    f" WHEN {kind} NOT IN ({', '.join(map(lit, types))}) THEN '{name} is ' || {kind}")
        return out

    q["reply_rejects"] = _q(replies, f"""checked AS (
        SELECT doc_id, 'relevance' AS step, relevance_reply AS reply,
          {fault('rr', ('relevance', ['string']))} END AS error FROM rep JOIN pr USING (doc_id)
        UNION ALL SELECT doc_id, 'duplicate', duplicate_reply,
          {fault('dr', ('is_duplicate', ['string']), ('match_with', ['number', 'string']))}
          WHEN {bad_index} THEN 'match_with is no index' END FROM rep JOIN pr USING (doc_id))""",
                            body="""SELECT step, CAST(doc_id AS VARCHAR) AS key, error AS message,
        CAST(to_json({'reply': reply}) AS VARCHAR) AS detail FROM checked WHERE error IS NOT NULL""")
    q["relevance_rules"] = _q(REVIEWS, RELEVANCE, body="""SELECT review_id, relevance_score,
        relevant FROM rel""")
    q["relevance_bayes"] = f"""WITH lab AS (
          SELECT l.doc_id, d.text, l.quality = 1 AS y FROM labels l JOIN documents d USING (doc_id)),
        tok AS (SELECT doc_id, y, unnest(list_distinct({toks('text')})) AS tok FROM lab),
        counts AS (SELECT tok, count(*) FILTER (y) AS n1, count(*) FILTER (NOT y) AS n0 FROM tok
                   WHERE doc_id % 5 <> 0 GROUP BY tok),
        total AS (SELECT sum(n1) + count(*) AS t1, sum(n0) + count(*) AS t0 FROM counts),
        weights AS (SELECT tok, CAST(floor(1000000 * ln(CAST(n1 + 1 AS DOUBLE) / t1)) AS BIGINT)
                     - CAST(floor(1000000 * ln(CAST(n0 + 1 AS DOUBLE) / t0)) AS BIGINT) AS weight
                    FROM counts, total),
        prior AS (SELECT CAST(floor(1000000 * ln(CAST(count(*) FILTER (y) + 1 AS DOUBLE)
                   / (count(*) FILTER (NOT y) + 1))) AS BIGINT) AS p FROM lab WHERE doc_id % 5 <> 0),
        score AS (SELECT l.doc_id, l.y, CAST(coalesce(sum(w.weight), 0) + any_value(p) AS BIGINT) AS s
                  FROM lab l LEFT JOIN tok t USING (doc_id) LEFT JOIN weights w USING (tok), prior
                  WHERE l.doc_id % 5 = 0 GROUP BY 1, 2)
        SELECT doc_id, s AS bayes_score, s > 0 AS relevant, y AS labelled FROM score"""
    q["relevance_bayes_all"] = f"""WITH lab AS (
          SELECT l.doc_id, d.text, l.quality = 1 AS y FROM labels l JOIN documents d USING (doc_id)),
        ltok AS (SELECT doc_id, y, unnest(list_distinct({toks('text')})) AS tok FROM lab
                 WHERE doc_id % 5 <> 0),
        counts AS (SELECT tok, count(*) FILTER (y) AS n1, count(*) FILTER (NOT y) AS n0 FROM ltok
                   GROUP BY tok),
        total AS (SELECT sum(n1) + count(*) AS t1, sum(n0) + count(*) AS t0 FROM counts),
        weights AS (SELECT tok, CAST(floor(1000000 * ln(CAST(n1 + 1 AS DOUBLE) / t1)) AS BIGINT)
                     - CAST(floor(1000000 * ln(CAST(n0 + 1 AS DOUBLE) / t0)) AS BIGINT) AS weight
                    FROM counts, total),
        prior AS (SELECT CAST(floor(1000000 * ln(CAST(count(*) FILTER (y) + 1 AS DOUBLE)
                   / (count(*) FILTER (NOT y) + 1))) AS BIGINT) AS p FROM lab WHERE doc_id % 5 <> 0),
        tok AS (SELECT doc_id, unnest(list_distinct({toks('text')})) AS tok FROM documents),
        score AS (SELECT d.doc_id, CAST(coalesce(sum(w.weight), 0) + any_value(p) AS BIGINT) AS s
                  FROM documents d LEFT JOIN tok t USING (doc_id) LEFT JOIN weights w USING (tok), prior
                  GROUP BY 1)
        SELECT s.doc_id, s.s AS bayes_score, s.s > 0 AS relevant, l.y AS labelled,
               s.doc_id % 5 = 0 AS held_out FROM score s LEFT JOIN lab l USING (doc_id)"""
    q["category_rules"] = _q(REVIEWS, category_cte("reviews"), body="""SELECT review_id,
        category, category_score, tag_id FROM catt""")
    q["severity_tickets"] = _q(ticket_rows_cte(), body="""SELECT command_id, review_id, source,
        category, ticket_id, title, tag_id, body, owned_by, applies_to_part, severity, priority,
        needs_issue FROM trows2""")
    q["issues"] = _q(triage_cte(), body="""SELECT command_id, review_id, issue_id, ticket_id,
        title, body, priority, category FROM iss""")
    q["issues_typical"] = _q(triage_cte(), typical_cte(), body="""SELECT command_id, review_id,
        issue_id, title, body, priority, category FROM tiss""")
    active_at = "TIMESTAMP '2024-01-02 12:00:00'"
    q["messages_active"] = _q(ticket_rows_cte(), f"""msgs AS (
        SELECT command_id, review_id, 1 AS seq,
               'Creating ticket for review: ' || CAST(review_id AS VARCHAR) AS body, created_at
        FROM trows2
        UNION ALL SELECT command_id, review_id, 2, CASE WHEN category <> 'failed_to_infer_category'
          THEN 'Created ticket: <' || ticket_id || '> and it is categorized as ' || category
          ELSE 'Created ticket: <' || ticket_id || '> and it failed to be categorized' END,
          created_at FROM trows2
        UNION ALL SELECT command_id, review_id, 3,
          'Creating issue for review: ' || CAST(review_id AS VARCHAR), created_at
          FROM trows2 WHERE needs_issue
        UNION ALL SELECT command_id, review_id, 4, 'Created issue: <' ||
          {sha("'issue'", 'command_id', 'CAST(review_id AS VARCHAR)')} ||
          '> and it is categorized as ' || category, created_at FROM trows2 WHERE needs_issue),
        m2 AS (SELECT *, created_at + INTERVAL 1 MINUTE AS expires_at FROM msgs)""",
                                body=f"""SELECT command_id, review_id, CAST(seq AS BIGINT) AS seq,
        body, strftime(expires_at, '%Y-%m-%dT%H:%M:%S.%gZ') AS expires_at FROM m2
        WHERE expires_at > {active_at}""")
    store = "'playstore_reviews_process'"
    q["messages_latest"] = _q(COMMAND_EVENTS, parsed_cte(), f"""log AS (
        SELECT command_id, 1 AS seq, CASE WHEN status = 'help' THEN
          (CASE WHEN command = {store} THEN {lit(STORE_HELP)} ELSE {lit(SOCIAL_HELP)} END)
          ELSE 'Fetching reviews from ' || (CASE WHEN command = {store} THEN 'Playstore'
          ELSE 'Twitter' END) END AS body FROM parsed
        UNION ALL SELECT command_id, 2, CASE WHEN status = 'reject_not_integer'
          THEN 'Please enter a valid number' WHEN status IN ('warn_over_100', 'reject_over_100')
          THEN 'Please enter a number less than 100' END FROM parsed
        UNION ALL SELECT command_id, 3, CASE WHEN status IN ('ok', 'warn_over_100',
          'warn_non_positive') THEN 'Fetched ' || CAST(requested AS VARCHAR)
          || ' reviews, creating tickets now.' END FROM parsed)""",
                                body="""SELECT command_id, CAST(max(seq) AS BIGINT) AS seq,
        arg_max(body, seq) AS body FROM log WHERE body IS NOT NULL GROUP BY command_id""")
    q["rejects"] = _q(COMMAND_EVENTS, parsed_cte(), ROUTES_CTE, CONFIG, body="""
        SELECT 'command' AS step, CAST(command_id AS VARCHAR) AS key, status AS message,
          CAST(to_json(struct_pack(parameters := parameters)) AS VARCHAR) AS detail
        FROM parsed WHERE status LIKE 'reject%'
        UNION ALL SELECT 'route', CAST(event_id AS VARCHAR), 'no route for event type',
          CAST(to_json(struct_pack(event_type := event_type)) AS VARCHAR) FROM events
        WHERE event_type NOT IN (SELECT event_type FROM routes WHERE source = 'event')
        UNION ALL SELECT 'config', app_id, 'missing required input',
          CAST(to_json(struct_pack(config_error := config_error)) AS VARCHAR)
        FROM resolved WHERE config_error IS NOT NULL""")
    q["dedup_exact"] = _q(REVIEWS, f"""r AS (SELECT review_id, votes, {norm('text')} AS nt
        FROM reviews WHERE {longer('text', 3)})""", body="""SELECT 'all' AS command_id,
        first(review_id ORDER BY votes DESC, review_id) AS leader_id,
        CAST(count(*) AS BIGINT) AS total_reviews, CAST(sum(votes) AS BIGINT) AS total_votes
        FROM r GROUP BY nt""")
    topn_leaders = f"""f AS (SELECT *, {norm('text')} AS nt FROM top WHERE {longer('text', 3)}),
        g AS (SELECT command_id, nt, min(rank) AS lr FROM f GROUP BY 1, 2),
        tl AS (SELECT f.* FROM f JOIN g ON f.command_id = g.command_id AND f.nt = g.nt
               AND f.rank = g.lr)"""
    q["dedup_context"] = _q(REVIEWS, TOPN, topn_leaders, f"""ctx AS (SELECT command_id,
        review_id, row_number() OVER (PARTITION BY command_id ORDER BY rank) - 1 AS leader_idx,
        list(text) OVER (PARTITION BY command_id ORDER BY rank {before}) AS prev FROM tl)""",
                            body="""SELECT command_id, review_id, CAST(leader_idx AS BIGINT)
        AS leader_idx, CAST(coalesce(len(prev), 0) AS BIGINT) AS n_context,
        coalesce(array_to_string(prev, ',' || chr(10)), '') AS context FROM ctx""")
    rep = "reply"
    q["dedup_replay"] = _q(REVIEWS, TOPN, f"""rp AS (SELECT *, CASE review_id % 4
          WHEN 0 THEN '{{"is_duplicate":"false","match_with":-1}}'
          WHEN 1 THEN '{{"is_duplicate":"true","match_with":' || CAST(votes % 3 AS VARCHAR) || '}}'
          WHEN 2 THEN '{{"is_duplicate":"true","match_with":"' || CAST(votes % 2 AS VARCHAR) || '"}}'
          ELSE '{{"is_duplicate":true}}' END AS reply FROM top),
        d AS (SELECT *, {strict_true(rep, 'is_duplicate')} AS dup,
              {parse_int(jtext(rep, 'match_with'))} AS mw FROM rp),
        d2 AS (SELECT *, coalesce(sum(CASE WHEN NOT dup THEN 1 ELSE 0 END) OVER (
              PARTITION BY command_id ORDER BY rank {before}), 0) AS lb FROM d),
        ld AS (SELECT command_id, lb AS leader_idx, review_id AS leader_id, votes FROM d2
               WHERE NOT dup),
        dp AS (SELECT command_id, mw AS leader_idx, count(*) AS n, sum(votes) AS v FROM d2
               WHERE dup AND mw >= 0 AND mw < lb GROUP BY 1, 2)""",
                           body="""SELECT l.command_id, CAST(l.leader_idx AS BIGINT) AS leader_idx,
        l.leader_id, CAST(1 + coalesce(dp.n, 0) AS BIGINT) AS total_reviews,
        CAST(l.votes + coalesce(dp.v, 0) AS BIGINT) AS total_votes
        FROM ld l LEFT JOIN dp USING (command_id, leader_idx)""")
    q["summary_extract"] = _q(REVIEWS, "srcd AS (SELECT review_id, text FROM reviews)",
                              summary_cte("srcd", "sx", 5, 1),
                              body="SELECT review_id, title, summary FROM sx")
    q["triage_end_to_end"] = _q(triage_cte(), body="""SELECT command_id, review_id, ticket_id,
        title, tag_ids, body, owned_by, applies_to_part, severity,
        severity <> 'blocker' AS needs_issue, category, total_reviews, total_votes FROM tix""")
    tmpl = lit(RELEVANCE_TEMPLATE)
    prompts = f"""pr0 AS (SELECT r.review_id, r.text, c.app_name FROM reviews r
          LEFT JOIN resolved c USING (app_id)),
        prm AS (SELECT review_id, replace(replace({tmpl}, '{{app_name}}', coalesce(app_name, '')),
          '{{review}}', coalesce(text, '')) AS prompt FROM pr0),
        prs AS (SELECT review_id, prompt, sha256(prompt) AS prompt_sha FROM prm)"""
    q["model_map_replay"] = _q(REVIEWS, CONFIG, prompts, f"""lab AS (SELECT doc_id,
        CASE WHEN quality = 1 THEN 'true' ELSE 'false' END AS q FROM labels),
        rec AS (SELECT p.prompt_sha, CASE l.doc_id % 6
          WHEN 0 THEN '{{"relevance":"' || q || '","reason":"label"}}'
          WHEN 1 THEN '{{"relevance":' || q || '}}' WHEN 2 THEN '{{"relevance":null}}'
          WHEN 3 THEN '{{}}' WHEN 4 THEN 'not json'
          ELSE '```json' || chr(10) || '{{"relevance":"' || q || '"}}' || chr(10) || '```' END
          AS reply FROM lab l JOIN prs p ON p.review_id = l.doc_id),
        rec1 AS (SELECT prompt_sha, min(reply) AS reply FROM rec GROUP BY 1),
        out AS (SELECT p.review_id, p.prompt_sha, r.reply, {strip_fences('r.reply')} AS sr
          FROM prs p LEFT JOIN rec1 r USING (prompt_sha))""",
                               body=f"""SELECT review_id, prompt_sha, reply IS NOT NULL AS has_reply,
        {keep('sr')} AS keep FROM out""")
    yes = '{"relevance":"true","reason":"long enough"}'
    no = '{"relevance":"false","reason":"too short"}'
    q["model_map_udf"] = _q(REVIEWS, CONFIG, prompts, f"""mm AS (SELECT review_id,
        CASE WHEN len(regexp_extract_all(prompt, '{TOKEN_PATTERN}')) >= {LOCAL_MODEL_MIN_TOKENS}
          THEN {lit(yes)} ELSE {lit(no)} END AS reply FROM prs)""",
                            body=f"""SELECT review_id, reply, {keep('reply')} AS keep FROM mm""")
    q["stream_triage"] = _q(ticket_rows_cte(), RELEVANCE, body=f"""SELECT t.command_id,
        t.review_id, t.category, t.ticket_id, t.severity, t.priority, t.needs_issue
        FROM trows2 t JOIN rel USING (review_id) JOIN reviews r USING (review_id)
        WHERE rel.relevant AND {longer('r.text', 3)}""")
    q["stream_leaders"] = q["dedup_exact"]
    q["stream_command_leaders"] = _q(REVIEWS, f"""r AS (SELECT app_id, review_id, votes, {norm('text')} AS nt
        FROM reviews WHERE {longer('text', 3)})""", body="""SELECT app_id AS command_id,
        first(review_id ORDER BY votes DESC, review_id) AS leader_id,
        CAST(count(*) AS BIGINT) AS total_reviews, CAST(sum(votes) AS BIGINT) AS total_votes
        FROM r GROUP BY app_id, nt""")
    q["engagement_rank"] = _q(REVIEWS, """e AS (SELECT review_id,
        3 * votes + count(*) OVER (PARTITION BY username) AS engagement FROM reviews)""",
                              body="""SELECT review_id, engagement,
        row_number() OVER (ORDER BY engagement DESC, review_id) AS position FROM e""")
    q["page_connector"] = q["page_connector_stream"] = q["page_explode"]
    cut = " ".join(f"WHEN {i} THEN date_trunc('{unit}', ts)" for i, unit in (
        (0, "second"), (1, "millisecond"), (4, "millisecond")))
    q["webhook_once"] = f"""SELECT CASE WHEN event_id % 11 <> 0 THEN 'key-' || event_id END AS unique_key,
        event_type, CAST(event_id AS VARCHAR) AS work_id, 'ticket' AS work_type,
        strftime(CASE event_id % 5 {cut} ELSE ts END, '%Y-%m-%d %H:%M:%S.%f') AS event_ts
        FROM events WHERE event_type IN ('purchase', 'error')"""
    q["stream_events_once"] = """SELECT event_id, event_type,
        strftime(ts, '%Y-%m-%d %H:%M:%S.%f') AS ts FROM events"""
    q["command_tickets"] = f"""WITH RECURSIVE {command_triage_cte()} SELECT command_id, review_id, ticket_id,
        title, tag_ids, body, owned_by, applies_to_part, severity, category, total_reviews, total_votes FROM tix"""
    q["command_issues"] = f"""WITH RECURSIVE {command_triage_cte()} SELECT command_id, review_id, issue_id,
        ticket_id, title, body, priority, category FROM iss"""
    q["stream_commands"] = f"""WITH RECURSIVE {command_triage_cte()},
      ev AS (SELECT p.*, a.app, command_id % 97 = 0 AS cut, command_id % 89 = 0 AS unnamed
             FROM parsed p JOIN cmd_a a USING (command_id)),
      ran AS (SELECT * FROM ev WHERE NOT cut AND NOT unnamed AND parameters IS NOT NULL AND app IS NOT NULL),
      t AS (SELECT command_id, count(*) AS tickets, sum(total_reviews) AS reviews FROM tix GROUP BY 1),
      i AS (SELECT command_id, count(*) AS issues FROM iss GROUP BY 1),
      outs AS (SELECT CAST(command_id AS VARCHAR) AS key, coalesce(t.tickets, 0) AS tickets,
          coalesce(t.reviews, 0) AS reviews, coalesce(i.issues, 0) AS issues,
          CASE r.status WHEN 'help' THEN 1 WHEN 'reject_unknown_mode' THEN 1 WHEN 'warn_over_100' THEN 3 ELSE 2 END
            + 2 * coalesce(t.tickets, 0) + 2 * coalesce(i.issues, 0) AS messages,
          CASE WHEN r.status LIKE 'reject%' THEN 'command: ' || r.status
               WHEN r.fetch_n > 0 AND coalesce(c.config_error, CASE WHEN c.app_id IS NULL THEN 'app_id' END) IS NOT NULL
               THEN 'config: missing required input' END AS reject
        FROM ran r LEFT JOIN t USING (command_id) LEFT JOIN i USING (command_id)
        LEFT JOIN resolved c ON c.app_id = r.app
      UNION ALL SELECT CASE WHEN cut THEN sha256('{{"payload":{{"command_id":"' || command_id || '","parameters":')
          ELSE CAST(command_id AS VARCHAR) END, 0, 0, 0, 0,
          CASE WHEN cut THEN 'event: corrupt record' WHEN parameters IS NULL THEN 'event: missing parameters'
               ELSE 'event: missing installation_id' END
        FROM ev WHERE cut OR unnamed OR parameters IS NULL OR app IS NULL)
      SELECT key, CAST(tickets AS BIGINT) AS tickets, CAST(reviews AS BIGINT) AS reviews,
        CAST(issues AS BIGINT) AS issues, CAST(messages AS BIGINT) AS messages, reject FROM outs"""
    q.update(neardup_sql())
    return q


def neardup_sql() -> dict[str, str]:
    """Brute force: all node pairs by Jaccard, then a recursive walk in rank
    order that carries the leader list (the sequential rule itself)."""
    rows = f"""r AS (SELECT review_id, votes, {norm('text')} AS nt, list_distinct({toks('text')}) AS ts
      FROM reviews WHERE {longer('text', 3)})"""
    base = _leader_walk(rows, JACCARD)
    # the same walk, of texts against earlier leaders' summaries
    rows = f"""srcd AS (SELECT review_id, text FROM reviews WHERE {longer('text', 3)}),
{summary_cte('srcd', 'sx', 5, 1)},
r AS (SELECT review_id, votes, {norm('text')} AS nt, list_distinct({toks('text')}) AS ts,
        list_distinct({toks('summary')}) AS ss
      FROM reviews JOIN sx USING (review_id) WHERE {longer('text', 3)})"""
    of_summary = "len(a.ss) > 0 AND 5 * len(list_intersect(a.ss, b.ts)) >= 4 * len(a.ss)"
    leaders = """SELECT r.review_id, nl.leader AS leader_id,
            r.review_id = nl.leader AS is_leader
            FROM r JOIN nodes n USING (nt) JOIN nl ON nl.node = n.node"""
    return {
        "dedup_leaders": base + leaders,
        "dedup_pairs": base + """SELECT bnode AS review_id, anode AS leader_id,
            CAST(inter AS BIGINT) AS inter, CAST(uni AS BIGINT) AS uni FROM lp""",
        "dedup_summary": _leader_walk(rows, of_summary) + leaders,
    }


def _leader_walk(rows: str, similar: str) -> str:
    """CTEs up to ``nl`` (node, leader): nodes of ``rows`` in rank order walked
    with the leaders so far; ``similar`` compares a later node b to a leader a."""
    return f"""WITH RECURSIVE {REVIEWS},
{rows},
nodes AS (SELECT nt, first(review_id ORDER BY votes DESC, review_id) AS node FROM r GROUP BY nt),
nd AS (SELECT n.node, r.* EXCLUDE (review_id, votes, nt), row_number() OVER (ORDER BY r.votes DESC, r.review_id) AS rk
       FROM nodes n JOIN r ON r.review_id = n.node),
edges AS (SELECT a.rk AS ark, b.rk AS brk, a.node AS anode, b.node AS bnode,
    len(list_intersect(a.ts, b.ts)) AS inter, len(list_distinct(list_concat(a.ts, b.ts))) AS uni
  FROM nd a JOIN nd b ON a.rk < b.rk WHERE {similar}),
nb AS (SELECT nd.rk, list(e.ark) FILTER (WHERE e.ark IS NOT NULL) AS earlier
       FROM nd LEFT JOIN edges e ON e.brk = nd.rk GROUP BY nd.rk),
walk(rk, leaders) AS (SELECT CAST(0 AS BIGINT), CAST([] AS BIGINT[])
  UNION ALL SELECT w.rk + 1, CASE WHEN len(list_intersect(w.leaders,
      coalesce(nb.earlier, CAST([] AS BIGINT[])))) > 0 THEN w.leaders
      ELSE list_append(w.leaders, w.rk + 1) END
  FROM walk w JOIN nb ON nb.rk = w.rk + 1),
fin AS (SELECT unnest(leaders) AS rk FROM walk WHERE rk = (SELECT max(rk) FROM nd)),
lp AS (SELECT e.* FROM edges e WHERE e.ark IN (SELECT rk FROM fin)
       AND e.brk NOT IN (SELECT rk FROM fin)),
att AS (SELECT bnode AS node, arg_min(anode, ark) AS leader FROM lp GROUP BY bnode),
nl AS (SELECT nd.node, coalesce(att.leader, nd.node) AS leader FROM nd LEFT JOIN att USING (node))
"""
