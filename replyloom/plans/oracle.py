"""The same results as plain SQL over the given tables, for comparison.

The SQL engine used for checking has neither look-around nor Unicode word
boundaries, so edges are written as captured neighbours; patterns whose matches
may share such a neighbour are applied twice.
"""

from __future__ import annotations

from replyloom.config import (
    ESCALATION_SUFFIX,
    GENERIC_REPLY,
    GUIDANCE_PREFIX,
    WEAK_LABEL_SOURCE,
)
from replyloom.functions.text import BLANK_MESSAGE, LONG_MESSAGE, MESSAGE_MAX_CHARS
from replyloom.functions.values import RUBRIC_FIELDS
from replyloom.functions.rules import FALLBACK_LABEL
from replyloom.operators import review
from replyloom.operators.labels import BLANK_ANNOTATIONS, SENSITIVE_LABELS
from replyloom.plans import inputs
from replyloom.plans.inputs import FIRST_SECOND, LANGUAGE_RULES, TEMPLATES, TERMS

W = r"\p{L}\p{N}_"


def quoted(value: str) -> str:
    return "'" + value.replace("'", "''") + "'"


def swap(x: str, pattern: str, to: str) -> str:
    return f"regexp_replace({x}, {quoted(pattern)}, {quoted(to)}, 'g')"


def normalized(x: str) -> str:
    email = rf"(^|[^{W}])([{W}][{W}.+-]*@[{W}.-]+\.[A-Za-z]{{2,}})($|[^{W}])"
    number = rf"(^|[^{W}])(\p{{Nd}}{{5,}})($|[^{W}])"
    x = f"coalesce({x}, '')"
    x = swap(swap(x, email, r"\1<EMAIL>\3"), email, r"\1<EMAIL>\3")
    x = swap(x, r"(?i)https?://\S+|www\.\S+", "<URL>")
    x = swap(x, rf"(^|[^{W}])@[A-Za-z0-9_]+", r"\1<HANDLE>")
    x = swap(swap(x, number, r"\1<NUMBER>\3"), number, r"\1<NUMBER>\3")
    return f"trim({swap(x, r'\s+', ' ')})"


def sanitized(x: str) -> str:
    x = normalized(x)
    x = swap(x, r"^<HANDLE>[,!.\s-]*", "")
    x = swap(x, r"(?i)^(hi|hey|hello)(\s+there)?[,!.\s-]*", "")
    x = swap(x, r"^<HANDLE>[,!.\s-]*", "")
    x = swap(x, r"\s*/[A-Z]{2}\s*(<URL>)?\s*$", "")
    return f"trim({x})"


def folded(x: str) -> str:
    return f"replace(lower({x}), 'ß', 'ss')"


def matching(x: str) -> str:
    bare = swap(normalized(x), r"(?i)<(EMAIL|URL|HANDLE|NUMBER)>", " ")
    collapsed = swap(bare, r"\s+", " ")
    return folded(f"trim({collapsed})")


def rule_case(x: str, what: str) -> str:
    arms = []
    for name, stems in LANGUAGE_RULES:
        pattern = rf"(?i)(^|[^{W}])((?:{stems})[{W}]*)"
        value = quoted(name) if what == "intent" else f"regexp_extract({x}, {quoted(pattern)}, 2)"
        arms.append(f"WHEN regexp_matches({x}, {quoted(pattern)}) THEN {value}")
    default = "'other_unclear'" if what == "intent" else "''"
    return f"CASE {' '.join(arms)} ELSE {default} END"


def guidance(x: str) -> str:
    words = "thnd|erre|quement|schen"
    blocked = rf"(?i)<(EMAIL|URL|HANDLE|NUMBER)>|(^|[^{W}])({words})"
    start = rf"(?i)^(the|and|of|la|der|de|in)($|[^{W}])"
    sentences = f"regexp_extract_all({x}, '[^.!?]+[.!?]|[^.!?]+$')"
    kept = (
        f"list_filter(list_transform({sentences}, lambda s: trim(s)), "
        f"lambda s: regexp_matches(s, {quoted(start)}))"
    )
    joined = f"array_to_string({kept}, ' ')"
    return f"CASE WHEN regexp_matches({x}, {quoted(blocked)}) THEN '' ELSE {joined} END"


def terms_in(x: str, terms: tuple[str, ...]) -> str:
    items = ", ".join(quoted(t) for t in terms)
    edge = f"(^|[^{W}])"
    return (
        f"array_to_string(list_filter([{items}], lambda t: "
        f"regexp_matches({x}, {quoted(edge)} || t || '($|[^{W}])')), ',')"
    )


def template_case(intent: str) -> str:
    arms = " ".join(
        f"WHEN {intent} = {quoted(k)} THEN {quoted(v)}"
        for k, v in TEMPLATES.items()
        if k != "other_unclear"
    )
    return f"CASE {arms} ELSE {quoted(TEMPLATES['other_unclear'])} END"


def key_json(model: str, content: str, draft: str, evidence: str) -> str:
    return (
        f"sha256(to_json({{'draft': {draft}, 'evidence_sha256': sha256({evidence}), 'model': {model}, "
        f"'rubric_version': 'support-draft-v2', 'text': {content}}})::VARCHAR)"
    )


MESSAGES = f"""msgs AS (
  SELECT conv_id * 1000 + turn AS tweet_id,
         CASE WHEN role = 'user' THEN 'user-' || conv_id ELSE role END AS author_id,
         role = 'user' AS inbound,
         strftime(make_timestamp(({FIRST_SECOND} + conv_id * 3600 + turn * 60) * 1000000),
                  '%a %b %d %H:%M:%S +0000 %Y') AS created_at,
         {FIRST_SECOND} + conv_id * 3600 + turn * 60 AS secs,
         text,
         CASE WHEN turn > 0 THEN conv_id * 1000 + turn - 1 END AS in_response_to_tweet_id
  FROM conversations)"""

ROOTS = """walk AS (
  SELECT tweet_id AS start, in_response_to_tweet_id AS node, 1 AS hops FROM msgs
  WHERE in_response_to_tweet_id IS NOT NULL
  UNION ALL
  SELECT w.start, m.in_response_to_tweet_id, w.hops + 1 FROM walk w JOIN msgs m ON m.tweet_id = w.node
  WHERE m.in_response_to_tweet_id IS NOT NULL AND w.hops < 100),
roots AS (SELECT start AS tweet_id, arg_max(node, hops) AS thread_id FROM walk GROUP BY start)"""

FLOODED = f"""turns0 AS (
  SELECT *, conv_id * 1000 + turn AS tweet_id, role = 'assistant' AND (turn // 2) % 2 = 1 AND turn >= 3 AS late FROM conversations),
turns1 AS (
  SELECT *, {FIRST_SECOND} + conv_id * 3600 + turn * 60 + CASE WHEN late AND conv_id % 3 = 0 THEN 3 * 86400
    WHEN late AND conv_id % 3 = 1 THEN -400 ELSE 0 END AS secs FROM turns0),
msgs0 AS (
  SELECT tweet_id, CASE WHEN role = 'user' THEN 'user-' || conv_id ELSE role END AS author_id, role = 'user' AS inbound,
    strftime(make_timestamp(secs * 1000000), '%a %b %d %H:%M:%S +0000 %Y') AS created_at, secs, text,
    CASE WHEN turn > 0 THEN CASE WHEN late THEN tweet_id - 3 ELSE tweet_id - 1 END END AS in_response_to_tweet_id
  FROM turns1),
flood AS (
  SELECT * FROM msgs0
  UNION ALL SELECT * REPLACE ('edited ' || text AS text) FROM msgs0 WHERE inbound AND (tweet_id // 1000) % 5 = 0),
msgs AS (
  SELECT * EXCLUDE (rn) FROM (
    SELECT *, row_number() OVER (PARTITION BY tweet_id ORDER BY created_at, author_id, text) AS rn FROM flood) WHERE rn = 1)"""

FOREST = """msgs AS (
  SELECT e AS tweet_id, CASE
    WHEN b % 4 = 0 AND e % 300 > 0 THEN (e % 300 - 1) // 3 + 300 * b
    WHEN b % 4 = 1 AND e % 300 > 0 THEN e - 1
    WHEN b % 4 = 2 THEN CASE WHEN e % 50 > 0 THEN e - 1 ELSE e + 49 - b % 2 END
    WHEN b % 4 = 3 AND e % 7 = 0 THEN -e - 1
    WHEN b % 4 = 3 AND e % 300 > 0 THEN e - 1 END AS parent
  FROM (SELECT event_id AS e, event_id // 300 AS b FROM events)),
walk AS (
  SELECT tweet_id AS start, parent AS node, [tweet_id] AS seen FROM msgs WHERE parent IS NOT NULL
  UNION ALL
  SELECT w.start, m.parent, list_append(w.seen, w.node) FROM walk w JOIN msgs m ON m.tweet_id = w.node
  WHERE m.parent IS NOT NULL AND len(w.seen) < 100 AND NOT list_contains(w.seen, w.node)),
roots AS (SELECT start AS tweet_id, arg_max(node, len(seen)) AS thread_id FROM walk GROUP BY start)"""

REPLIES = """firsts AS (
  SELECT * FROM (
    SELECT in_response_to_tweet_id AS customer_tweet_id, tweet_id AS reply_tweet_id,
           created_at AS reply_created_at, text AS reply_text,
           row_number() OVER (PARTITION BY in_response_to_tweet_id ORDER BY {order}, tweet_id) AS rn
    FROM msgs WHERE author_id = 'assistant' AND NOT inbound AND in_response_to_tweet_id IS NOT NULL)
  WHERE rn = 1)"""


def pairs_cte(order: str = "secs") -> str:
    return f"""{REPLIES.format(order=order)},
cleaned AS (
  SELECT m.tweet_id AS customer_tweet_id, m.author_id AS customer_author_id,
         m.created_at AS customer_created_at, {normalized('m.text')} AS customer_text,
         f.reply_tweet_id, f.reply_created_at, {sanitized('f.reply_text')} AS brand_reply
  FROM msgs m JOIN firsts f ON f.customer_tweet_id = m.tweet_id),
pairs0 AS (
  SELECT * EXCLUDE (rn) FROM (
    SELECT *, row_number() OVER (PARTITION BY customer_text ORDER BY customer_tweet_id) AS rn
    FROM cleaned
    WHERE length(customer_text) >= 8 AND length(brand_reply) >= 8
      AND NOT starts_with(customer_text, 'RT '))
  WHERE rn = 1)"""


LABELLED = """labelled AS (
  SELECT 'doc-' || lpad(l.doc_id::VARCHAR, 7, '0') AS example_id, l.doc_id::VARCHAR AS tweet_id,
         't' || (l.doc_id // 2) AS thread_id, d.text, d.lang AS intent,
         CASE WHEN l.toxic = 1 THEN 'escalate' ELSE 'auto_handle' END AS decision,
         CASE WHEN l.quality = 1 THEN ' Yes ' ELSE 'no' END AS reviewed,
         d.source, l.quality, d.n_chars
  FROM labels l JOIN documents d USING (doc_id))"""

DOC_PAIRS = """doc_pairs AS (
  SELECT doc_id AS customer_tweet_id, doc_id // 10 AS thread_id, text AS customer_text,
         source || ' ' || lang AS brand_reply FROM documents)"""

HELD_OUT = """held AS (
  SELECT tweet_id, tweet_id::BIGINT // 10 AS thread_id, text FROM labelled WHERE decision = 'escalate')"""

PREDICTIONS = f"""major AS (
  SELECT intent FROM labelled GROUP BY intent ORDER BY count(*) DESC, min(example_id) LIMIT 1),
raw_predictions AS (
  SELECT example_id, 'trivial' AS system, intent AS actual_intent, decision AS actual_decision,
         (SELECT intent FROM major) AS predicted_intent, 'escalate' AS predicted_decision,
         {quoted(GENERIC_REPLY)} AS draft_reply, source FROM labelled
  UNION ALL
  SELECT example_id, 'keyword', intent, decision, rule,
         CASE WHEN rule IN ('de', 'es', 'other_unclear') THEN 'escalate' ELSE 'auto_handle' END,
         CASE WHEN rule IN ('de', 'es') THEN {quoted(GENERIC_REPLY)}
              ELSE 'Thanks for contacting us about ' || replace(rule, '_', ' ')
                   || '. Please try the relevant help-center steps.' END, source
  FROM (SELECT *, {rule_case('text', 'intent')} AS rule FROM labelled)
  UNION ALL
  SELECT example_id, 'main', intent, decision,
         CASE WHEN quality = 1 THEN intent ELSE 'en' END,
         CASE WHEN quality = 1 THEN 'auto_handle' ELSE 'escalate' END, 'See ' || source, source
  FROM labelled),
predictions AS (SELECT * FROM raw_predictions)"""


def score_sql(offset: int, width: int) -> str:
    return f"((n_chars // {width} + {offset}) % 5 + 1)"


JUDGE = f"""judge AS (
  SELECT example_id, 'main' AS system, 'judge-a' AS model, 'support-draft-v2' AS rubric_version,
         {key_json("'judge-a'", 'text', 'source', 'intent')} AS cache_key,
         {', '.join(f'{score_sql(i, 7 + i)} AS {f}' for i, f in enumerate(RUBRIC_FIELDS))},
         'by length' AS rationale FROM labelled)"""

HUMAN = f"""human AS (
  SELECT example_id, 'main' AS system, text, source AS draft_reply, '[]' AS evidence_json,
         {key_json("'judge-a'", 'text', 'source', 'intent')} AS cache_key,
         {', '.join(f'{score_sql(i, 9 + i)}::VARCHAR AS {f}' for i, f in enumerate(RUBRIC_FIELDS))},
         'reader' AS annotator, CASE WHEN quality = 1 THEN 'yes' ELSE 'no' END AS reviewed
  FROM labelled)"""

CONTENT = f"""content AS (
  SELECT p.*, l.text AS customer_text, '[{{"id":"' || p.source || '"}}]' AS evidence_json,
         {key_json("'judge-a'", 'l.text', 'p.draft_reply', """('[{"id":"' || p.source || '"}]')""")} AS cache_key
  FROM predictions p JOIN labelled l USING (example_id))"""

REPORT = """joint AS (
  SELECT system, actual_intent, predicted_intent, count(*) AS n FROM predictions GROUP BY ALL),
totals AS (
  SELECT system, label, sum(support)::BIGINT AS support, sum(predicted)::BIGINT AS predicted, sum(correct)::BIGINT AS correct
  FROM (SELECT system, actual_intent AS label, n AS support, 0 AS predicted,
               CASE WHEN actual_intent = predicted_intent THEN n ELSE 0 END AS correct FROM joint
        UNION ALL SELECT system, predicted_intent, 0, n, 0 FROM joint)
  GROUP BY system, label),
report AS (
  SELECT system, label,
         CASE WHEN predicted = 0 THEN 0.0 ELSE correct::DOUBLE / predicted END AS precision,
         CASE WHEN support = 0 THEN 0.0 ELSE correct::DOUBLE / support END AS recall,
         2.0 * correct / (predicted + support) AS f1, support FROM totals)"""

METRICS = """macro AS (SELECT system, avg(f1) AS macro_f1 FROM report GROUP BY system),
c AS (
  SELECT system, count(*) AS k, count(*) FILTER (actual_intent = predicted_intent) AS hit,
    count(*) FILTER (actual_decision = 'escalate' AND predicted_decision = 'escalate') AS caught,
    count(*) FILTER (predicted_decision = 'escalate') AS sent,
    count(*) FILTER (actual_decision = 'escalate' AND predicted_decision <> 'escalate') AS missed,
    count(*) FILTER (actual_decision = 'escalate') AS must,
    count(*) FILTER (predicted_decision <> 'escalate') AS auto FROM predictions GROUP BY system),
measured AS (SELECT system, round(hit::DOUBLE / k, 9) AS accuracy, round(macro_f1, 9) AS macro_f1,
  round(CASE WHEN sent = 0 THEN 0 ELSE caught::DOUBLE / sent END, 9) AS escalation_precision,
  round(CASE WHEN must = 0 THEN 0 ELSE caught::DOUBLE / must END, 9) AS must_escalate_recall,
  round(CASE WHEN sent + must = 0 THEN 0 ELSE 2.0 * caught / (sent + must) END, 9) AS escalation_f1,
  missed AS false_auto_handle_count, must AS must_escalate_count, auto AS auto_handle_count,
  round(CASE WHEN must = 0 THEN 0 ELSE missed::DOUBLE / must END, 9) AS false_auto_handle_rate,
  round(CASE WHEN auto = 0 THEN 0 ELSE missed::DOUBLE / auto END, 9) AS false_auto_handle_fraction_among_auto_handled,
  round(auto::DOUBLE / k, 9) AS auto_handle_coverage
FROM c JOIN macro USING (system))"""


def queue_cte(limit: str = "") -> str:
    blanks = ", ".join(f"'' AS {c}" for c in BLANK_ANNOTATIONS)
    return f"""{DOC_PAIRS},
sampled AS (
  SELECT *, md5('42:' || customer_tweet_id) AS rank_key FROM doc_pairs ORDER BY rank_key, customer_tweet_id {limit}),
queue AS (
  SELECT 'label-' || lpad((row_number() OVER (ORDER BY rank_key, customer_tweet_id) - 1)::VARCHAR, 4, '0') AS example_id,
         customer_tweet_id::VARCHAR AS tweet_id, thread_id::VARCHAR AS thread_id,
         customer_text AS text, brand_reply AS historical_reply, {blanks}, 'no' AS reviewed
  FROM sampled)"""


def term_rows(source: str, ident: str) -> str:
    """(id, space, term, n) of ``source(id, x)``."""
    return f"""
  SELECT {ident}, space, term, count(*) AS n FROM (
    SELECT {ident}, 'word' AS space, unnest(list_concat(w, list_transform(range(1, len(w)), lambda i: w[i] || ' ' || w[i + 1]))) AS term
    FROM (SELECT {ident}, regexp_extract_all(x, '[{W}]{{2,}}') AS w FROM {source})
    UNION ALL
    SELECT {ident}, 'char', substr(p, i, k) FROM (
      SELECT {ident}, p, k, unnest(range(1, length(p) - k + 2)) AS i FROM (
        SELECT {ident}, p, unnest([3, 4, 5]) AS k FROM (
          SELECT {ident}, ' ' || unnest(string_split(x, ' ')) || ' ' AS p FROM {source} WHERE x <> ''))
      WHERE k <= length(p)))
  GROUP BY {ident}, space, term"""


def vocabulary_cte(counts: str, docs: str, min_df: int, word_max: float, name: str = "vocabulary") -> str:
    return f"""{name} AS (
  SELECT space, term, count(*) AS df, ln((1.0 + docs) / (1.0 + count(*))) + 1.0 AS idf
  FROM {counts}, (SELECT count(*) AS docs FROM {docs}) GROUP BY space, term, docs
  HAVING count(*) >= {min_df} AND count(*) <= (CASE WHEN space = 'word' THEN {word_max} ELSE 1.0 END) * docs)"""


def weights_cte(name: str, counts: str, ident: str) -> str:
    return f"""{name} AS (
  SELECT {ident}, space, term, w / sqrt(sum(w * w) OVER (PARTITION BY {ident}, space)) AS weight
  FROM (SELECT c.{ident}, v.space, v.term, (1 + ln(c.n)) * v.idf AS w
        FROM {counts} c JOIN vocabulary v ON v.space = c.space AND v.term = c.term))"""


ASKED = f"asked AS (SELECT item_id AS message_id, {matching('text')} AS x FROM benchmark)"
ASKED_TURNS = f"asked AS (SELECT tweet_id AS message_id, {matching('text')} AS x FROM msgs WHERE inbound)"
ASKED_DOCUMENTS = f"asked AS (SELECT doc_id AS message_id, {matching('text')} AS x FROM documents)"
ASKED_FIFTIETH = f"asked AS (SELECT doc_id AS message_id, {matching('text')} AS x FROM documents WHERE doc_id % 50 = 0)"
TURNS = f"""turns AS (SELECT tweet_id, {matching('text')} AS x FROM msgs WHERE inbound)"""
PAIR_CASES = "(SELECT customer_tweet_id, customer_tweet_id // 1000 * 1000 AS thread_id, customer_text, brand_reply FROM pairs0)"


def cases_cte(source: str = PAIR_CASES, where: str = "true") -> str:
    """Cases of an index with their terms; ``source`` is in the layout of pairs."""
    return f"""cases AS (SELECT * FROM (
  SELECT *, row_number() OVER (PARTITION BY x ORDER BY customer_tweet_id) AS rn
  FROM (SELECT *, {matching('customer_text')} AS x FROM {source})
  WHERE x <> '' AND trim(brand_reply) <> '' AND {where}) WHERE rn = 1),
counts AS ({term_rows('cases', 'customer_tweet_id')}),
{vocabulary_cte('counts', 'cases', 1, 1.0)},
{weights_cte('case_weights', 'counts', 'customer_tweet_id')}"""


def ranked_cte() -> str:
    """Cases ranked for ``asked(message_id, x)``, every pair scored."""
    return f"""asked_counts AS ({term_rows('asked', 'message_id')}), {weights_cte('asked_weights', 'asked_counts', 'message_id')},
sums AS (
  SELECT q.message_id, c.customer_tweet_id,
    round(sum(CASE WHEN q.space = 'word' THEN q.weight * c.weight ELSE 0 END), 9) AS word_similarity,
    round(sum(CASE WHEN q.space = 'char' THEN q.weight * c.weight ELSE 0 END), 9) AS char_similarity
  FROM asked_weights q JOIN case_weights c USING (space, term) GROUP BY ALL),
blended AS (
  SELECT s.*, k.thread_id, round(0.65 * word_similarity + 0.35 * char_similarity, 9) AS similarity
  FROM sums s JOIN cases k USING (customer_tweet_id)),
best AS (SELECT *, row_number() OVER (PARTITION BY message_id, thread_id ORDER BY similarity DESC, customer_tweet_id) AS rn
  FROM blended WHERE similarity > 0),
ranked AS (SELECT *, row_number() OVER (PARTITION BY message_id ORDER BY similarity DESC, customer_tweet_id) AS rank FROM best WHERE rn = 1)"""


FOUND = """SELECT message_id, rank::INTEGER AS rank, customer_tweet_id, thread_id::VARCHAR AS thread_id, round(similarity, 6) AS similarity,
  round(word_similarity, 6) AS word_similarity, round(char_similarity, 6) AS char_similarity
FROM ranked WHERE rank <= 3"""


def predicted_cte() -> str:
    """``predicted(message_id, intent, p, q)`` of the formula classifier for ``asked_counts``."""
    classes = ", ".join(quoted(c) for c in (*inputs.LANGUAGES, "other_unclear"))
    return f"""model_counts AS ({term_rows('turns', 'tweet_id')}),
{vocabulary_cte('model_counts', 'turns', 2, 0.98, 'model_terms')},
raw AS (
  SELECT a.message_id, v.space, v.term, (1 + ln(a.n)) * v.idf AS w
  FROM asked_counts a JOIN model_terms v ON v.space = a.space AND v.term = a.term),
unit AS (SELECT message_id, term, w / sqrt(sum(w * w) OVER (PARTITION BY message_id, space)) AS w FROM raw),
classes AS (SELECT unnest([{classes}]) AS class, unnest(range(5)) AS i),
margins AS (
  SELECT a.message_id, class, i, i / 10.0::DOUBLE + coalesce(sum(w * ((('0x' || substr(md5(term || '|' || class), 1, 4))::INTEGER % 2001 - 1000) / 100.0::DOUBLE)), 0) AS m
  FROM asked a CROSS JOIN classes LEFT JOIN unit u ON u.message_id = a.message_id GROUP BY a.message_id, class, i),
shares AS (
  SELECT message_id, class, i, exp(m - top) / sum(exp(m - top)) OVER w AS p
  FROM (SELECT *, max(m) OVER (PARTITION BY message_id) AS top FROM margins) WINDOW w AS (PARTITION BY message_id)),
placed AS (SELECT *, row_number() OVER (PARTITION BY message_id ORDER BY p DESC, i DESC) AS place FROM shares),
predicted AS (
  SELECT message_id, max(CASE WHEN place = 1 THEN class END) AS intent, max(CASE WHEN place = 1 THEN p END) AS p,
         max(CASE WHEN place = 2 THEN p END) AS q FROM placed GROUP BY message_id)"""


def answers_cte() -> str:
    """``answers`` to ``scored(message_id, text, intent, p, q)`` with the cases in ``ranked``."""
    return f"""found AS (SELECT message_id, count(*) AS cases_found, max(similarity) AS best FROM ranked WHERE rank <= 3 GROUP BY message_id),
quotes AS (
  SELECT message_id, arg_min(g, rank) AS quote, arg_min(customer_tweet_id, rank) AS quoted_id FROM (
    SELECT r.message_id, r.rank, r.customer_tweet_id, {guidance('x')} AS g
    FROM (SELECT r.*, {sanitized('c.brand_reply')} AS x FROM ranked r JOIN cases c USING (customer_tweet_id)
          WHERE rank <= 3 AND r.similarity >= 0.05) r)
  WHERE g <> '' GROUP BY message_id),
gated AS (
  SELECT s.*, coalesce(cases_found, 0) AS cases_found, quote, quoted_id, CASE WHEN risks <> '' THEN 'risk term requires human review'
    WHEN intent = 'es' THEN intent || ' is configured for human review'
    WHEN intent NOT IN ('en', 'fr', 'de') THEN 'intent is not approved for automatic handling'
    WHEN p < 0.4 THEN 'intent confidence is below threshold'
    WHEN p - q < 0.1 THEN 'top intent predictions are too close'
    WHEN coalesce(best, 0) < 0.05 THEN 'no sufficiently similar historical resolution' END AS gate
  FROM (SELECT *, {terms_in(folded('text'), ('thnd', 'erheb'))} AS risks FROM scored) s
  LEFT JOIN found USING (message_id) LEFT JOIN quotes USING (message_id)),
answers AS (
  SELECT message_id, intent, round(p, 4) AS confidence, risks,
    CASE WHEN gate IS NULL AND quote IS NOT NULL THEN 'auto_handle' ELSE 'escalate' END AS decision,
    CASE WHEN gate IS NOT NULL THEN gate WHEN quote IS NULL THEN 'no safe applicable historical guidance'
         ELSE 'low-risk case with confident intent and supporting evidence' END AS reason,
    {template_case('intent')} || CASE WHEN gate IS NULL AND quote IS NOT NULL THEN {quoted(GUIDANCE_PREFIX)} || quote
         ELSE {quoted(ESCALATION_SUFFIX)} END AS draft_reply,
    CASE WHEN gate IS NULL THEN coalesce(quoted_id::VARCHAR, '') ELSE '' END AS evidence_tweet_ids,
    CASE WHEN gate IS NOT NULL THEN 'not_used_for_escalation' WHEN quote IS NULL THEN 'no_safe_evidence' ELSE 'extractive' END AS rag_mode,
    cases_found::INTEGER AS cases_found FROM gated)"""


INCOMING = f"""incoming AS (
  SELECT message_id, CASE WHEN (message_id % 17 + 17) % 17 = 0 THEN '@someone 1234567'
    WHEN (message_id % 13 + 13) % 13 = 0 THEN repeat(text, 60) ELSE text END AS text
  FROM (SELECT tweet_id AS message_id, text FROM msgs WHERE inbound AND tweet_id NOT IN (
          SELECT in_response_to_tweet_id FROM msgs WHERE author_id = 'assistant' AND in_response_to_tweet_id IS NOT NULL)
        UNION ALL SELECT -1 - item_id, text FROM benchmark)),
checked AS (
  SELECT *, CASE WHEN {matching('text')} = '' THEN {quoted(BLANK_MESSAGE)}
    WHEN length(text) > {MESSAGE_MAX_CHARS} THEN {quoted(LONG_MESSAGE % MESSAGE_MAX_CHARS)} END AS refused FROM incoming),
accepted AS (SELECT message_id, {normalized('text')} AS text FROM checked WHERE refused IS NULL),
asked AS (SELECT message_id, {matching('text')} AS x FROM accepted)"""


def triage_cte() -> str:
    return f"""{MESSAGES}, {TURNS}, {pairs_cte()}, {cases_cte()}, {INCOMING}, {ranked_cte()}, {predicted_cte()},
scored AS (SELECT a.message_id, a.text, intent, p, q FROM accepted a JOIN predicted USING (message_id)),
{answers_cte()},
everything AS (
  SELECT message_id, intent, confidence, decision, reason, draft_reply, evidence_tweet_ids, rag_mode, cases_found FROM answers
  UNION ALL SELECT message_id, NULL, NULL, 'rejected', refused, NULL, NULL, NULL, NULL FROM checked WHERE refused IS NOT NULL)"""


def check_union(rows: list[tuple[str, str]]) -> str:
    return " UNION ALL ".join(f"SELECT {quoted(name)} AS check, ({count}) AS violations" for name, count in rows)


def count_if(source: str, condition: str) -> str:
    return f"SELECT count(*) FROM {source} WHERE {condition}"


def surplus(source: str, key: str) -> str:
    return f"SELECT coalesce(sum(k - 1), 0)::BIGINT FROM (SELECT count(*) AS k FROM {source} GROUP BY {key})"


def shared(left: str, right: str, a: str, b: str) -> str:
    return f"SELECT count(*) FROM (SELECT {a} AS v FROM {left} INTERSECT SELECT {b} FROM {right})"


def blank(c: str) -> str:
    return f"trim({c}) = ''"


def build() -> dict[str, str]:
    sql: dict[str, str] = {}
    keyword_sensitive = ", ".join(quoted(x) for x in (*SENSITIVE_LABELS, FALLBACK_LABEL))
    doc = lambda e, name: f"SELECT doc_id, {e} AS {name} FROM documents"

    sql["read_messages"] = f"WITH {MESSAGES} SELECT * EXCLUDE (secs) FROM msgs"
    sql["read_table"] = "SELECT doc_id::VARCHAR AS doc_id, text, lang, source FROM documents"
    sql["write_table"] = "SELECT * FROM documents"
    sql["write_if_empty"] = (
        "SELECT count(*) AS queue_rows, true AS refused_second_write FROM documents"
    )
    part = lambda s: f"sum(('0x' || substr(h, {s}, 8))::UBIGINT)::HUGEINT::VARCHAR"
    digest_parts = " || chr(31) || ".join(
        f"'v' || {c}" for c in ("doc_id", "text", "lang", "source", "n_chars")
    )
    sql["fingerprint"] = f"""
SELECT count(*) AS row_count,
       md5(concat_ws('-', count(*)::VARCHAR, {', '.join(part(s) for s in (1, 9, 17, 25))})) AS digest
FROM (SELECT md5({digest_parts}) AS h FROM documents)"""

    sql["changed_ranges"] = """
WITH three AS (SELECT doc_id FROM documents ORDER BY md5(doc_id::VARCHAR), doc_id LIMIT 3),
hit AS (SELECT DISTINCT doc_id // 16 AS node FROM three)
SELECT node * 16 AS first_key, node * 16 + 15 AS last_key, count(*) AS rows_before, count(*) AS rows_after
FROM hit JOIN documents d ON d.doc_id // 16 = node GROUP BY node"""
    sql["normalize_text"] = doc(normalized("text"), "cleaned")
    sql["sanitize_reply"] = doc(sanitized("text"), "reply")
    sql["normalize_for_matching"] = doc(matching("text"), "matching")
    sql["safe_guidance"] = (
        f"SELECT doc_id, {guidance('x')} AS guidance FROM (SELECT doc_id, {sanitized('text')} AS x FROM documents)"
    )
    sql["rule_label"] = (
        f"SELECT doc_id, {rule_case('text', 'intent')} AS intent, {rule_case('text', 'match')} AS rule_match FROM documents"
    )
    sql["matched_terms"] = doc(terms_in(folded("text"), TERMS), "terms")
    sql["cache_key"] = doc(key_json("'judge-a'", "text", "source", "lang"), "cache_key")
    sql["humanize"] = doc("replace(lang || '_' || source, '_', ' ')", "label")
    sql["draft_reply"] = f"""WITH {LABELLED}
SELECT example_id, {template_case('intent')} || CASE WHEN decision = 'escalate' THEN {quoted(ESCALATION_SUFFIX)}
  WHEN quality = 1 THEN {quoted(GUIDANCE_PREFIX)} || source ELSE '' END AS draft_reply FROM labelled"""
    sql["validate_message"] = f"""
SELECT doc_id, CASE WHEN x = '' THEN {quoted(BLANK_MESSAGE)} WHEN length(text) > {MESSAGE_MAX_CHARS} THEN {quoted(LONG_MESSAGE % MESSAGE_MAX_CHARS)} ELSE '' END AS reason
FROM (SELECT doc_id, text, {matching('text')} AS x FROM documents)"""
    sql["parse_json_strict"] = """
SELECT event_id, variant, CASE WHEN variant = 0 THEN json(props)::VARCHAR END AS parsed
FROM events, (SELECT unnest([0, 1, 2])::INTEGER AS variant)"""
    sql["parse_score"] = """
SELECT event_id, CASE WHEN value BETWEEN 1 AND 5 AND value = floor(value) THEN value::INTEGER END AS score FROM events"""
    sql["is_reviewed"] = f"WITH {LABELLED} SELECT example_id, lower(trim(reviewed)) = 'yes' AS done FROM labelled"

    sql["brand_direct_replies"] = f"""WITH {MESSAGES} SELECT tweet_id, in_response_to_tweet_id, created_at FROM msgs
WHERE author_id = 'assistant' AND NOT inbound AND in_response_to_tweet_id IS NOT NULL"""
    sql["usable_pairs"] = f"""WITH {DOC_PAIRS} SELECT customer_tweet_id, r AS brand_reply FROM (
  SELECT customer_tweet_id, {normalized('customer_text')} AS c, {sanitized('brand_reply')} AS r FROM doc_pairs)
WHERE length(c) >= 8 AND length(r) >= 8 AND NOT starts_with(c, 'RT ')"""
    sql["nonempty_normalized"] = f"""WITH {MESSAGES} SELECT author_id, count(*) AS n FROM msgs WHERE {matching('text')} <> '' GROUP BY author_id"""
    sql["reviewed_rows"] = f"WITH {LABELLED} SELECT example_id, intent FROM labelled WHERE quality = 1"
    sql["pending_work"] = f"WITH {LABELLED} SELECT example_id, decision FROM labelled WHERE quality <> 1"
    sql["safe_evidence"] = f"""
SELECT doc_id AS customer_tweet_id, similarity, g AS guidance FROM (
  SELECT doc_id, (doc_id % 50) / 50.0::DOUBLE AS similarity, {guidance('x')} AS g
  FROM (SELECT doc_id, {sanitized('text')} AS x FROM documents))
WHERE g <> '' AND similarity >= 0.35"""
    scores = ", ".join(RUBRIC_FIELDS)
    sql["usable_cache"] = f"""WITH {LABELLED}, {JUDGE}
SELECT cache_key, {', '.join(f'arg_max({f}, example_id)::INTEGER AS {f}' for f in RUBRIC_FIELDS)} FROM judge GROUP BY cache_key"""
    errors = """SELECT *, actual_intent <> predicted_intent AS intent_error,
  actual_decision <> predicted_decision AS decision_error,
  actual_decision = 'escalate' AND predicted_decision = 'auto_handle' AS false_auto FROM predictions
WHERE actual_intent <> predicted_intent OR actual_decision <> predicted_decision"""
    sql["error_rows"] = f"""WITH {LABELLED}, {PREDICTIONS}
SELECT example_id, system, intent_error, decision_error, false_auto FROM ({errors})"""

    sql["reply_pairs"] = f"""WITH RECURSIVE {FLOODED}, {ROOTS}, {pairs_cte()}
SELECT p.*, coalesce(r.thread_id, p.customer_tweet_id) AS thread_id, 'assistant' AS brand
FROM pairs0 p LEFT JOIN roots r ON r.tweet_id = p.customer_tweet_id"""
    sql["reply_pairs_lexical"] = f"""WITH {FLOODED}, {pairs_cte('created_at')}
SELECT customer_tweet_id, reply_tweet_id, customer_tweet_id // 1000 * 1000 AS thread_id FROM pairs0"""
    sql["wanted_messages"] = f"""WITH {MESSAGES} SELECT tweet_id, author_id, text FROM msgs WHERE tweet_id IN (
  SELECT in_response_to_tweet_id FROM msgs WHERE author_id = 'assistant' AND NOT inbound)"""
    sql["thread_root"] = f"WITH RECURSIVE {MESSAGES}, {ROOTS} SELECT * FROM roots"
    sql["thread_root_forest"] = f"WITH RECURSIVE {FOREST} SELECT * FROM roots"
    kept = f"""kept AS (
  SELECT * FROM doc_pairs p WHERE thread_id NOT IN (SELECT thread_id FROM held)
    AND {matching('customer_text')} NOT IN (SELECT {matching('text')} FROM held)
    AND customer_tweet_id::VARCHAR NOT IN (SELECT tweet_id FROM held))"""
    sql["exclude_held_out"] = f"""WITH {LABELLED}, {HELD_OUT}, {DOC_PAIRS}, {kept}
SELECT customer_tweet_id, thread_id FROM kept"""
    sql["predictions_with_text"] = f"""WITH {LABELLED}, {PREDICTIONS}
SELECT p.example_id, p.system, p.draft_reply, length(l.text)::INTEGER AS text_chars
FROM predictions p JOIN labelled l USING (example_id)"""
    sql["cache_misses"] = f"""WITH {LABELLED}, {PREDICTIONS}, {CONTENT}
SELECT DISTINCT cache_key, draft_reply, evidence_json FROM content WHERE cache_key NOT IN (
  SELECT cache_key FROM content WHERE example_id IN (SELECT example_id FROM labelled WHERE quality = 1))"""
    sql["compare_worksheets"] = f"""WITH {LABELLED}, {HUMAN}
SELECT example_id, system,
  CASE WHEN length(text) < 500 THEN 'removed with work'
       WHEN draft_reply = 'src3' THEN 'added'
       WHEN length(text) > 5000 THEN 'changed' ELSE 'kept' END AS status
FROM human WHERE NOT (length(text) < 500 AND draft_reply = 'src3')"""
    merged = ", ".join(
        f"CASE WHEN draft_reply = 'src3' THEN '' ELSE {f} END AS {f}" for f in (*RUBRIC_FIELDS, "annotator")
    )
    sql["merge_worksheet"] = f"""WITH {LABELLED}, {HUMAN}
SELECT example_id, system, draft_reply, evidence_json, cache_key, {merged},
  CASE WHEN draft_reply = 'src3' THEN 'no' ELSE reviewed END AS reviewed FROM human"""
    usable_text = matching("q.text")
    sql["apply_annotations"] = f"""WITH {LABELLED}, {queue_cte()}
SELECT q.example_id, q.tweet_id, CASE WHEN ok THEN l.intent ELSE '' END AS intent,
  CASE WHEN ok THEN l.decision ELSE '' END AS decision,
  CASE WHEN ok AND l.decision = 'escalate' THEN 'unsafe' ELSE '' END AS escalation_reason,
  CASE WHEN ok THEN 'reader' ELSE '' END AS annotator, CASE WHEN ok THEN 'yes' ELSE 'no' END AS reviewed
FROM (SELECT q.*, coalesce(l.quality = 1 AND {usable_text} <> '', false) AS ok
      FROM queue q LEFT JOIN labelled l USING (tweet_id)) q LEFT JOIN labelled l USING (tweet_id)"""
    sql["rejected_annotations"] = f"""WITH {LABELLED}, judged AS (
  SELECT example_id, CASE WHEN intent NOT IN ('en', 'fr', 'es') THEN 'select a valid intent and decision'
    WHEN decision = 'escalate' THEN 'explain why this case needs human review'
    WHEN source = 'src3' THEN 'provide required reply points and forbidden claims'
    WHEN n_chars <= 400 AND text <> 'changed' THEN 'unknown or changed example'
    WHEN {matching('text')} = '' THEN 'unusable text or thread id' END AS reason FROM labelled)
SELECT example_id, reason FROM judged WHERE reason IS NOT NULL"""
    fresh = ", ".join(f"CASE WHEN ok THEN j.{f}::VARCHAR ELSE '' END AS {f}" for f in RUBRIC_FIELDS)
    within = " AND ".join(f"{f} <= 4" for f in RUBRIC_FIELDS)
    sql["apply_scores"] = f"""WITH {LABELLED}, {HUMAN}, {JUDGE}
SELECT h.example_id, h.system, h.draft_reply, h.cache_key, {fresh},
  CASE WHEN ok THEN 'reader' ELSE '' END AS annotator, CASE WHEN ok THEN 'yes' ELSE 'no' END AS reviewed
FROM human h JOIN (SELECT *, {within} AS ok FROM judge) j USING (example_id)"""

    sql["brand_profile"] = f"""WITH {MESSAGES}
SELECT b.brand, count(m.tweet_id) AS brand_messages, count(m.in_response_to_tweet_id) AS direct_replies,
  count(DISTINCT m.in_response_to_tweet_id) AS unique_customers_replied_to
FROM (SELECT unnest(['assistant', 'system', 'nobody']) AS brand) b
LEFT JOIN msgs m ON m.author_id = b.brand AND NOT m.inbound GROUP BY b.brand"""
    sql["label_counts"] = f"WITH {LABELLED} SELECT intent, count(*) AS n FROM labelled GROUP BY intent"
    sql["rare_labels"] = f"WITH {LABELLED} SELECT intent, count(*) AS n FROM labelled GROUP BY intent HAVING count(*) < 60"
    sql["majority_label"] = f"""WITH {LABELLED}
SELECT intent, count(*) AS n FROM labelled GROUP BY intent ORDER BY n DESC, min(example_id) LIMIT 1"""
    usable = f"""by_text AS (
  SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY x ORDER BY example_id) AS rn
                 FROM (SELECT *, {matching('text')} AS x FROM @source)
                 WHERE x <> '') WHERE rn = 1),
usable AS (
  SELECT * FROM (SELECT * EXCLUDE (rn), row_number() OVER (PARTITION BY thread_id ORDER BY example_id) AS rn FROM by_text)
  WHERE rn = 1),
per_intent AS (SELECT intent, count(*) AS n FROM usable GROUP BY intent)"""
    entries = """'{{' || coalesce((SELECT string_agg('"' || intent || '":' || n, ',' ORDER BY intent) FROM per_intent WHERE {where}), '') || '}}'"""
    sql["annotation_progress"] = f"""WITH {LABELLED}, done AS (SELECT * FROM labelled WHERE quality = 1),
{usable.replace('@source', 'done')},
totals AS (
  SELECT (SELECT count(*) FROM labelled) AS queue_rows, (SELECT count(*) FROM done) AS reviewed_rows,
         (SELECT count(*) FROM done WHERE {matching('text')} = '') AS invalid_reviewed_rows,
         (SELECT count(*) FROM usable) AS usable_unique_thread_rows)
SELECT *, {entries.format(where='true')} AS intent_counts, 150 AS golden_size, 250 AS minimum_reviewed_rows,
  greatest(0, 250 - usable_unique_thread_rows) AS additional_usable_rows_needed,
  {entries.format(where='n < 2')} AS intents_with_fewer_than_two_rows,
  (SELECT coalesce(string_agg(i, ',' ORDER BY i), '') FROM (SELECT unnest(['de', 'en', 'es', 'fr', 'it']) AS i)
   WHERE i NOT IN (SELECT intent FROM per_intent)) AS unrepresented_intents,
  usable_unique_thread_rows >= 250 AND invalid_reviewed_rows = 0
    AND NOT EXISTS (SELECT 1 FROM per_intent WHERE n < 2) AS split_precheck_passed
FROM totals"""
    sql["system_metrics"] = f"WITH {LABELLED}, {PREDICTIONS}, {REPORT}, {METRICS} SELECT * FROM measured"
    sql["per_label_report"] = f"""WITH {LABELLED}, {PREDICTIONS}, {REPORT}
SELECT system, label, round(precision, 9) AS precision, round(recall, 9) AS recall, round(f1, 9) AS f1, support FROM report"""
    means = ", ".join(f"round(avg({c}), 9) AS macro_{c}" for c in ("precision", "recall", "f1"))
    weighted = ", ".join(
        f"round(sum({c} * support) / sum(support), 9) AS weighted_{c}" for c in ("precision", "recall", "f1")
    )
    sql["report_averages"] = f"""WITH {LABELLED}, {PREDICTIONS}, {REPORT}
SELECT system, {means}, {weighted}, sum(support)::BIGINT AS support FROM report GROUP BY system"""
    sql["confusion"] = f"""WITH {LABELLED}, {PREDICTIONS}, {REPORT},
names AS (SELECT DISTINCT system, label FROM totals)
SELECT a.system, a.label AS actual_intent, b.label AS predicted_intent, coalesce(j.n, 0) AS n
FROM names a JOIN names b USING (system)
LEFT JOIN joint j ON j.system = a.system AND j.actual_intent = a.label AND j.predicted_intent = b.label"""
    wide = ", ".join(
        f"count(*) FILTER (predicted_intent = '{name}') AS {name}" for name in inputs.LANGUAGES
    )
    sql["confusion_wide"] = f"""WITH {LABELLED}, {PREDICTIONS}
SELECT system, actual_intent, {wide} FROM predictions GROUP BY system, actual_intent"""
    sql["cohen_kappa"] = f"""WITH {LABELLED}, ruled AS (SELECT *, {rule_case('text', 'intent')} AS rule FROM labelled),
paired AS (
  SELECT 'intent' AS field, intent AS a, rule AS b FROM ruled
  UNION ALL SELECT 'decision', decision,
    CASE WHEN rule IN ('de', 'es', 'other_unclear') THEN 'escalate' ELSE 'auto_handle' END FROM ruled),
po AS (SELECT field, count(*) AS examples, avg(CASE WHEN a = b THEN 1.0 ELSE 0.0 END) AS agreed FROM paired GROUP BY field),
l AS (SELECT field, a AS label, count(*) AS k FROM paired GROUP BY ALL),
r AS (SELECT field, b AS label, count(*) AS k FROM paired GROUP BY ALL),
pe AS (SELECT l.field, sum(l.k * r.k) AS chance FROM l JOIN r ON l.field = r.field AND l.label = r.label GROUP BY l.field)
SELECT field, round((agreed - chance::DOUBLE / (examples * examples)) / (1 - chance::DOUBLE / (examples * examples)), 9) AS kappa, examples
FROM po JOIN pe USING (field)"""
    sides = " UNION ALL ".join(
        f"SELECT '{f}' AS criterion, j.{f}::INTEGER AS x, h.{f}::INTEGER AS y FROM judge j "
        f"JOIN human h USING (example_id, system) WHERE h.reviewed = 'yes'"
        for f in RUBRIC_FIELDS
    )
    sql["judge_human_agreement"] = f"""WITH {LABELLED}, {JUDGE}, {HUMAN}, cells AS ({sides}),
ranked AS (
  SELECT *, rank() OVER (PARTITION BY criterion ORDER BY x) + (count(*) OVER (PARTITION BY criterion, x) - 1) / 2.0 AS rx,
    rank() OVER (PARTITION BY criterion ORDER BY y) + (count(*) OVER (PARTITION BY criterion, y) - 1) / 2.0 AS ry FROM cells)
SELECT criterion, round(corr(rx, ry), 9) AS spearman, round(avg(CASE WHEN x = y THEN 1.0 ELSE 0 END), 9) AS exact_agreement,
  round(avg(CASE WHEN abs(x - y) <= 1 THEN 1.0 ELSE 0 END), 9) AS within_one_agreement, count(*) AS examples
FROM ranked GROUP BY criterion"""
    sql["score_summary"] = f"""WITH {LABELLED}, {JUDGE}
SELECT system, {', '.join(f'round(avg({f}), 9) AS {f}' for f in RUBRIC_FIELDS)} FROM judge GROUP BY system"""
    sql["class_weights"] = f"""WITH {LABELLED}, c AS (SELECT intent, count(*) AS n FROM labelled GROUP BY intent)
SELECT intent, n, round((SELECT sum(n) FROM c) / ((SELECT count(*) FROM c) * n::DOUBLE), 9) AS weight FROM c"""
    sql["readiness_status"] = f"""WITH {LABELLED}, t AS (
  SELECT count(*) AS queue_rows, count(*) FILTER (decision = 'auto_handle') AS training_rows,
    count(*) FILTER (decision = 'escalate') AS golden_rows, count(*) FILTER (quality = 1) AS reviewed_human_score_rows FROM labelled)
SELECT *, array_to_string(list_filter([
  CASE WHEN training_rows < 100 THEN {quoted(review.BLOCK_TRAINING)} END,
  CASE WHEN golden_rows NOT BETWEEN 150 AND 250 THEN {quoted(review.BLOCK_GOLDEN)} END,
  {quoted(review.BLOCK_EVIDENCE + 'predictions')},
  CASE WHEN reviewed_human_score_rows = 0 THEN {quoted(review.BLOCK_SCORES)} END],
  lambda b: b IS NOT NULL), '|') AS blockers, false AS final_submission_ready FROM t"""

    sql["dedupe_first"] = f"SELECT min(doc_id) AS doc_id FROM documents GROUP BY {matching('text')}"
    sql["diverse_topk"] = """
SELECT * EXCLUDE (rn) FROM (
  SELECT *, row_number() OVER (PARTITION BY message_id ORDER BY similarity DESC, customer_tweet_id)::INTEGER AS rank FROM (
    SELECT user_id AS message_id, event_type AS thread_id, event_id AS customer_tweet_id, value AS similarity,
      row_number() OVER (PARTITION BY user_id, event_type ORDER BY value DESC, event_id) AS rn FROM events)
  WHERE rn = 1) WHERE rank <= 3"""
    sql["top2_probs"] = """
SELECT event_id, s[1].c AS intent, s[1].p AS confidence, s[2].p AS second_confidence FROM (
  SELECT event_id, list_reverse_sort([{'p': value, 'c': 'a'}, {'p': user_id::DOUBLE, 'c': 'b'}, {'p': 20.0::DOUBLE, 'c': 'c'}]) AS s FROM events)"""
    sql["sample_n"] = """
SELECT doc_id, lang, n_chars FROM documents ORDER BY md5('42:' || doc_id), doc_id LIMIT 800"""
    sql["number_examples"] = """
SELECT doc_id, lang, 'label-' || lpad((row_number() OVER (ORDER BY r, doc_id) - 1)::VARCHAR, 4, '0') AS example_id
FROM (SELECT doc_id, lang, md5('7:' || doc_id) AS r FROM documents ORDER BY r, doc_id LIMIT 800)"""
    quota = """sized AS (
  SELECT intent, n, floor(n * (sum(n) OVER () - 150) / (sum(n) OVER ())::DOUBLE) AS base,
    round(n * (sum(n) OVER () - 150) / (sum(n) OVER ())::DOUBLE - floor(n * (sum(n) OVER () - 150) / (sum(n) OVER ())::DOUBLE), 12) AS rest,
    sum(n) OVER () AS total FROM per_intent),
quotas AS (
  SELECT intent, n, (n - base - CASE WHEN row_number() OVER (ORDER BY rest DESC, intent)
      <= total - 150 - sum(base) OVER () THEN 1 ELSE 0 END)::INTEGER AS golden_quota FROM sized)"""
    sql["split_quotas"] = f"""WITH {LABELLED}, per_intent AS (SELECT intent, count(*) AS n FROM labelled GROUP BY intent), {quota}
SELECT * FROM quotas"""
    sql["stratified_split"] = f"""WITH {LABELLED}, {usable.replace('@source', 'labelled')}, {quota}
SELECT example_id, CASE WHEN row_number() OVER (PARTITION BY u.intent ORDER BY md5('42:' || example_id), example_id)
  <= golden_quota THEN 'golden' ELSE 'train' END AS part FROM usable u JOIN quotas q ON q.intent = u.intent"""
    sampled_ids = "chosen AS (SELECT example_id FROM labelled ORDER BY md5('42:' || example_id), example_id LIMIT 50)"
    sql["paired_sample"] = f"""WITH {LABELLED}, {PREDICTIONS}, {sampled_ids}
SELECT example_id, system, md5('42:' || example_id || ':' || system) AS judge_order FROM predictions JOIN chosen USING (example_id)"""
    sql["failure_queue"] = f"""WITH {LABELLED}, {PREDICTIONS}
SELECT example_id, intent_error, decision_error, false_auto, '' AS failure_mode, 'no' AS reviewed
FROM ({errors}) WHERE system = 'main'"""

    sql["stack_systems"] = f"""WITH {LABELLED}, {PREDICTIONS}
SELECT example_id, system, predicted_intent, predicted_decision, draft_reply FROM predictions"""
    good, poor = "(SELECT * FROM labelled WHERE quality = 1)", "(SELECT * FROM labelled WHERE quality = 0)"
    sql["overlap"] = f"WITH {LABELLED} " + check_union(
        [
            ("thread", shared(good, poor, "thread_id", "thread_id")),
            ("source", shared(good, poor, "source", "source")),
        ]
    )
    sql["missing_pairs"] = f"""WITH {LABELLED}, {PREDICTIONS}
SELECT example_id, system, 'lost' AS side FROM predictions WHERE predicted_decision <> 'escalate'
UNION ALL SELECT example_id, 'unknown', 'unknown' FROM labelled"""
    texts = ", ".join(f"{f}::VARCHAR AS {f}" for f in RUBRIC_FIELDS)
    sql["upsert_scores"] = f"""WITH {LABELLED}, {JUDGE}
SELECT example_id, system, model, rubric_version, cache_key, {texts},
  CASE WHEN relevance = 1 THEN 'again' ELSE rationale END AS rationale FROM judge WHERE tone <> 2 OR relevance = 1"""

    normalized_docs = f"(SELECT doc_id, {matching('text')} AS x FROM documents)"
    sql["word_terms"] = f"""
SELECT doc_id, len(t)::INTEGER AS n_terms, md5(array_to_string(list_sort(t), '|')) AS digest FROM (
  SELECT doc_id, list_concat(w, list_transform(range(1, len(w)), lambda i: w[i] || ' ' || w[i + 1])) AS t
  FROM (SELECT doc_id, regexp_extract_all(x, '[{W}]{{2,}}') AS w FROM {normalized_docs}))"""
    sql["char_terms"] = f"""WITH d AS {normalized_docs},
g AS (SELECT doc_id, substr(p, i, k) AS term FROM (
  SELECT doc_id, p, k, unnest(range(1, length(p) - k + 2)) AS i FROM (
    SELECT doc_id, p, unnest([3, 4, 5]) AS k FROM (
      SELECT doc_id, ' ' || unnest(string_split(x, ' ')) || ' ' AS p FROM d WHERE x <> ''))
  WHERE k <= length(p)))
SELECT doc_id, count(term)::INTEGER AS n_terms, md5(coalesce(string_agg(term, '|' ORDER BY term), '')) AS digest
FROM d LEFT JOIN g USING (doc_id) GROUP BY doc_id"""
    turn_counts = f"{MESSAGES}, {TURNS}, counts AS ({term_rows('turns', 'tweet_id')})"
    model_vocabulary = vocabulary_cte("counts", "turns", 2, 0.98)
    sql["tfidf_fit"] = f"""WITH {turn_counts}, {model_vocabulary}
SELECT space, term, df, round(idf, 9) AS idf FROM vocabulary"""
    sql["tfidf_fit_documents"] = f"""WITH texts AS {normalized_docs}, counts AS ({term_rows('texts', 'doc_id')}),
{vocabulary_cte('counts', 'texts', 2, 0.98)}
SELECT space, substr(term, 1, 1) AS first, count(*) AS terms, sum(df)::BIGINT AS df, round(sum(idf), 4) AS idf FROM vocabulary GROUP BY ALL"""
    sql["tfidf_fit_top"] = f"""WITH texts AS {normalized_docs}, counts AS ({term_rows('texts', 'doc_id')}),
stats AS (SELECT space, term, count(*) AS df, sum(n) AS tf FROM counts GROUP BY space, term)
SELECT space, term, df, round(ln((1.0 + docs) / (1.0 + df)) + 1.0, 9) AS idf
FROM (SELECT *, row_number() OVER (PARTITION BY space ORDER BY tf DESC, term) AS rn FROM stats), (SELECT count(*) AS docs FROM texts)
WHERE rn <= 1000"""
    sql["tfidf_transform"] = f"""WITH {turn_counts}, {model_vocabulary}, {ASKED_TURNS},
asked_counts AS ({term_rows('asked', 'message_id')}), {weights_cte('asked_weights', 'asked_counts', 'message_id')}
SELECT message_id, space, term, round(weight, 7) AS weight FROM asked_weights"""
    sql["build_retrieval_corpus"] = f"""WITH {LABELLED}, {HELD_OUT}, {DOC_PAIRS}, {kept},
usable AS (SELECT * FROM (
  SELECT *, row_number() OVER (PARTITION BY {matching('customer_text')} ORDER BY customer_tweet_id) AS rn FROM kept
  WHERE {matching('customer_text')} <> '') WHERE rn = 1)
SELECT customer_tweet_id, thread_id::VARCHAR AS thread_id, {guidance('x')} AS safe_guidance
FROM (SELECT *, {sanitized('customer_text')} AS x FROM usable)"""
    sql["hybrid_retrieve"] = f"WITH {MESSAGES}, {pairs_cte()}, {cases_cte()}, {ASKED}, {ranked_cte()} {FOUND}"
    sql["hybrid_retrieve_documents"] = f"WITH {DOC_PAIRS}, {cases_cte('doc_pairs')}, {ASKED_FIFTIETH}, {ranked_cte()} {FOUND}"
    sql["save_load_index"] = f"""WITH {MESSAGES}, {pairs_cte()}, {cases_cte()}
SELECT space, count(*) AS n, count(DISTINCT customer_tweet_id) AS cases, count(DISTINCT term) AS terms, round(sum(weight), 4) AS weight
FROM case_weights GROUP BY space"""
    sql["index_upkeep"] = f"""WITH {LABELLED}, {HELD_OUT}, {DOC_PAIRS}, {kept}, {cases_cte('kept')}
SELECT space, count(*) AS n, count(DISTINCT customer_tweet_id) AS cases, count(DISTINCT term) AS terms, round(sum(weight), 4) AS weight
FROM case_weights GROUP BY space"""
    sql["respond"] = f"""WITH {MESSAGES}, {pairs_cte()}, {cases_cte()}, {ASKED_TURNS}, {ranked_cte()},
scored AS (
  SELECT *, {rule_case('text', 'intent')} AS intent, (length(text) % 100) / 100.0::DOUBLE AS p, (length(text) % 37) / 100.0::DOUBLE AS q
  FROM (SELECT tweet_id AS message_id, {normalized('text')} AS text FROM msgs WHERE inbound AND {matching('text')} <> '' AND length(text) <= {MESSAGE_MAX_CHARS})),
{answers_cte()}
SELECT message_id, intent, confidence, decision, reason, risks, draft_reply, rag_mode, cases_found FROM answers"""
    sql["train_intent_model"] = f"""WITH {MESSAGES}, {pairs_cte()},
texts AS (SELECT * FROM (
  SELECT customer_tweet_id, customer_text, x, row_number() OVER (PARTITION BY x ORDER BY customer_tweet_id) AS rn
  FROM (SELECT *, {matching('customer_text')} AS x FROM pairs0) WHERE x <> '') WHERE rn = 1
  ORDER BY md5('42:' || customer_tweet_id), customer_tweet_id LIMIT 12000)
SELECT DISTINCT {rule_case('customer_text', 'intent')} AS intent, (SELECT count(*) FROM texts) AS training_examples,
  true AS at_optimum, true AS loads_alike, 'weak_provisional' AS label_source FROM texts"""
    sql["predict_intent"] = f"""WITH {MESSAGES}, {TURNS}, {ASKED_DOCUMENTS}, asked_counts AS ({term_rows('asked', 'message_id')}), {predicted_cte()}
SELECT message_id, intent, round(p, 9) AS confidence, round(q, 9) AS second_confidence FROM predicted"""
    sql["triage"] = f"WITH {triage_cte()} SELECT * FROM everything"
    sql["triage_stream"] = f"WITH {triage_cte()} SELECT message_id, intent, decision, reason, rag_mode FROM everything"
    sql["evaluate_all"] = f"""WITH {LABELLED}, {usable.replace('@source', 'labelled')}, {quota},
split AS (
  SELECT u.*, row_number() OVER (PARTITION BY u.intent ORDER BY md5('42:' || example_id), example_id) <= golden_quota AS is_golden
  FROM usable u JOIN quotas q ON q.intent = u.intent),
golden AS (SELECT * FROM split WHERE is_golden),
{MESSAGES}, {TURNS}, {pairs_cte()},
{cases_cte(where=f"""thread_id::VARCHAR NOT IN (SELECT thread_id FROM golden) AND customer_tweet_id::VARCHAR NOT IN (SELECT tweet_id FROM golden)
    AND x NOT IN (SELECT {matching('text')} FROM golden)""")},
asked AS (SELECT example_id AS message_id, {matching('text')} AS x FROM golden), {ranked_cte()}, {predicted_cte()},
scored AS (
  SELECT p.message_id, {normalized('g.text')} AS text, p.intent, p.p, p.q FROM predicted p JOIN golden g ON g.example_id = p.message_id),
{answers_cte()},
major AS (SELECT intent FROM split WHERE NOT is_golden GROUP BY intent ORDER BY count(*) DESC, min(example_id) LIMIT 1),
ruled AS (SELECT *, {rule_case('text', 'intent')} AS rule FROM golden),
predictions AS (
  SELECT 'trivial' AS system, intent AS actual_intent, decision AS actual_decision, (SELECT intent FROM major) AS predicted_intent,
    'escalate' AS predicted_decision FROM golden
  UNION ALL SELECT 'keyword', intent, decision, rule, CASE WHEN rule IN ({keyword_sensitive}) THEN 'escalate' ELSE 'auto_handle' END FROM ruled
  UNION ALL SELECT 'main', g.intent, g.decision, a.intent, a.decision FROM golden g JOIN answers a ON a.message_id = g.example_id),
{REPORT}, {METRICS},
weighted AS (SELECT system, round(sum(f1 * support) / sum(support), 9) AS weighted_f1 FROM report GROUP BY system)
SELECT * FROM measured JOIN weighted USING (system)"""

    sql["decide"] = f"""
SELECT doc_id, CASE WHEN reason = 'low-risk case with confident intent and supporting evidence' THEN 'auto_handle' ELSE 'escalate' END AS action,
  reason, risks FROM (
  SELECT doc_id, risks, CASE WHEN risks <> '' THEN 'risk term requires human review'
    WHEN lang = 'es' THEN lang || ' is configured for human review'
    WHEN lang NOT IN ('en', 'fr') THEN 'intent is not approved for automatic handling'
    WHEN p < 0.72 THEN 'intent confidence is below threshold'
    WHEN p - q < 0.15 THEN 'top intent predictions are too close'
    WHEN s < 0.35 THEN 'no sufficiently similar historical resolution'
    ELSE 'low-risk case with confident intent and supporting evidence' END AS reason
  FROM (SELECT doc_id, lang, (n_chars % 100) / 100.0::DOUBLE AS p, (n_chars % 37) / 100.0::DOUBLE AS q,
    (doc_id % 50) / 50.0::DOUBLE AS s, {terms_in(folded('text'), ('thnd', 'quement', 'privacy'))} AS risks FROM documents))"""
    sql["select_evidence"] = """
SELECT event_id AS message_id,
  CASE WHEN value > 20 THEN NULL WHEN event_type = 'error' THEN 'a' WHEN c IN (0, 1, 2) THEN ['a', 'b', 'c'][c + 1]
    WHEN c = -1 THEN NULL ELSE 'a' END AS selected,
  CASE WHEN value > 20 THEN 'no_safe_evidence' WHEN event_type = 'error' THEN 'extractive_fallback'
    WHEN c IN (0, 1, 2) THEN 'ollama_selected' WHEN c = -1 THEN 'ollama_abstained' ELSE 'extractive_fallback' END AS rag_mode
FROM (SELECT *, (user_id % 6 - 2)::INTEGER AS c FROM events)"""
    sql["trivial_baseline"] = f"""WITH {LABELLED}, {PREDICTIONS}
SELECT example_id, predicted_intent, predicted_decision, draft_reply FROM predictions WHERE system = 'trivial'"""
    sql["keyword_baseline"] = f"""WITH {LABELLED}, {PREDICTIONS}
SELECT example_id, predicted_intent, predicted_decision, draft_reply, {rule_case('l.text', 'match')} AS rule_match
FROM predictions JOIN labelled l USING (example_id) WHERE system = 'keyword'"""
    sql["create_weak_labels"] = f"""
SELECT doc_id AS customer_tweet_id, {rule_case('text', 'intent')} AS intent, {rule_case('text', 'match')} AS rule_match,
  {quoted(WEAK_LABEL_SOURCE)} AS label_source
FROM (SELECT doc_id, text FROM (SELECT *, row_number() OVER (PARTITION BY x ORDER BY doc_id) AS rn
    FROM (SELECT doc_id, text, {matching('text')} AS x FROM documents) WHERE x <> '') WHERE rn = 1
  ORDER BY md5('42:' || doc_id), doc_id LIMIT 12000)"""
    sql["make_label_queue"] = f"WITH {queue_cte('LIMIT 800')} SELECT * FROM queue"
    judged = ", ".join(
        f"((length(customer_text) + length(draft_reply) + {i}) % 5 + 1)::INTEGER AS {f}"
        for i, f in enumerate(RUBRIC_FIELDS)
    )
    sql["judge_table"] = f"""WITH {LABELLED}, {PREDICTIONS}, {CONTENT}
SELECT example_id, system, 'judge-a' AS model, 'support-draft-v2' AS rubric_version, cache_key, {judged}, 'by length' AS rationale
FROM content"""
    empty = ", ".join(f"'' AS {f}" for f in (*RUBRIC_FIELDS, "annotator"))
    sql["prepare_worksheet"] = f"""WITH {LABELLED}, {PREDICTIONS}, {CONTENT}
SELECT example_id, system, customer_text AS text, draft_reply, evidence_json, cache_key, {empty}, 'no' AS reviewed
FROM content"""

    norm = matching("text")
    fields = ("decision", "example_id", "intent", "reviewed", "text", "thread_id", "tweet_id")
    rows = [(f"blank {c}", count_if("labelled", blank(c))) for c in fields]
    rows += [
        ("not reviewed", count_if("labelled", "quality <> 1")),
        ("invalid decision", "0"),
        ("unknown intent", count_if("labelled", "intent NOT IN ('en', 'fr', 'es')")),
        ("empty normalized text", count_if("labelled", f"{norm} = ''")),
        ("size", "SELECT CASE WHEN count(*) BETWEEN 150 AND 250 THEN 0 ELSE 1 END FROM labelled"),
        ("duplicate example_id", surplus("labelled", "example_id")),
        ("duplicate normalized text", surplus("labelled", norm)),
    ]
    sql["golden_checks"] = f"WITH {LABELLED} " + check_union(rows)
    fields = ("example_id", "intent", "reviewed", "text", "thread_id", "tweet_id")
    rows = [(f"blank {c}", count_if("labelled", blank(c))) for c in fields]
    rows += [
        ("not reviewed", count_if("labelled", "quality <> 1")),
        ("unknown intent", "0"),
        ("empty normalized text", count_if("labelled", f"{norm} = ''")),
        ("label source not human", "SELECT count(*) FROM labelled"),
        ("invalid decision", "0"),
        ("size", "0"),
        ("duplicate normalized text", surplus("labelled", norm)),
    ]
    sql["training_checks"] = f"WITH {LABELLED} " + check_union(rows)
    sql["model_input_checks"] = f"WITH {LABELLED} " + check_union(
        [
            ("blank text", count_if("labelled", f"{norm} = ''")),
            ("blank intent", "0"),
            ("not reviewed", count_if("labelled", "quality <> 1")),
            ("fewer than 100 rows", "SELECT CASE WHEN count(*) < 100 THEN 1 ELSE 0 END FROM labelled"),
            ("fewer than two intents", "0"),
            ("duplicate normalized text", surplus("labelled", norm)),
        ]
    )
    train, gold = "(SELECT * FROM labelled WHERE quality = 1)", "(SELECT * FROM labelled WHERE quality = 0)"
    corpus = "(SELECT doc_id::VARCHAR AS id, 't' || (doc_id // 2) AS thread_id, text FROM documents)"
    sql["leakage_checks"] = f"WITH {LABELLED} " + check_union(
        [
            ("training text", shared(train, gold, norm, norm)),
            ("training thread_id", shared(train, gold, "thread_id", "thread_id")),
            ("training example_id", shared(train, gold, "example_id", "example_id")),
            ("training tweet_id", shared(train, gold, "tweet_id", "tweet_id")),
            ("corpus thread_id", shared(corpus, gold, "thread_id", "thread_id")),
            ("corpus text", shared(corpus, gold, norm, norm)),
            ("corpus message id", shared(corpus, gold, "id", "tweet_id")),
        ]
    )
    partial = "(SELECT * FROM predictions WHERE system <> 'main' OR predicted_decision = 'escalate')"
    sql["pairing_checks"] = f"WITH {LABELLED}, {PREDICTIONS} " + check_union(
        [
            ("example without every system", f"SELECT count(*) FROM (SELECT example_id FROM {partial} GROUP BY example_id HAVING count(DISTINCT system) < 3)"),
            ("unknown example_id", "SELECT count(*) FROM labelled WHERE decision <> 'auto_handle'"),
            ("duplicate pair", "0"),
        ]
    )
    rows = [(f"blank {c}", "0" if c != "text" else count_if("human", blank("text"))) for c in ("cache_key", "example_id", "system", "text")]
    rows += [
        ("invalid cache_key", count_if("human", "tone = '1'")),
        ("malformed evidence_json", count_if("human", "tone = '4'")),
        ("reviewed not yes/no", "0"),
        ("reviewed without annotator", count_if("human", "tone = '3' AND reviewed = 'yes'")),
    ]
    for f in RUBRIC_FIELDS:
        rows.append((f"invalid {f}", count_if("human", "tone = '2'") if f == "safety" else "0"))
        rows.append((f"reviewed without {f}", "0"))
    sql["worksheet_checks"] = f"WITH {LABELLED}, {HUMAN} " + check_union(rows)
    sql["worksheet_columns"] = (
        "SELECT 'missing columns: annotator' AS check, 1::BIGINT AS violations "
        "UNION ALL SELECT 'unexpected columns: scored_by', 1"
    )
    sql["prediction_checks"] = f"WITH {LABELLED}, {PREDICTIONS} " + check_union(
        [
            ("invalid decision", "SELECT count(*) + count(*) FILTER (system = 'main') FROM predictions WHERE predicted_intent = 'fr'"),
            ("missing prediction", "0"),
            ("duplicate prediction", "SELECT count(*) FROM predictions WHERE system = 'main'"),
        ]
    )
    sql["provenance_checks"] = check_union(
        [
            ("same rows", "0"),
            ("more rows", "SELECT CASE WHEN count(*) > 0 THEN 1 ELSE 0 END FROM documents"),
        ]
    )
    return sql
