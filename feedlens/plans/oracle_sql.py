"""SQL text of the shared views used by the oracle queries.

The same column logic as the DataFrame code, written as plain SQL so that an
independent engine (DuckDB) can recompute every registered query from the
driver tables. Fixed word lists come from ``feedlens.constants``.
"""

from __future__ import annotations

from feedlens.constants import (EMOTION_LABELS, FIXTURE_NEGATIVE_WORDS, FIXTURE_POSITIVE_WORDS,
                                SENTIMENT_LABELS, TOXIC_KEYWORDS)
from feedlens.scoring.lexicon import EMOTION_WEIGHTS, SENTIMENT_WEIGHTS
from feedlens.sources.tables import messages_sql


def _words(ws) -> str:
    return ", ".join(f"'{w}'" for w in ws)


def _argmax_case(names: list[str], labels: list[str]) -> str:
    """First label whose value equals the maximum."""
    mx = f"greatest({', '.join(names)})"
    parts = " ".join(f"WHEN {n} = {mx} THEN '{lab}'" for n, lab in zip(names, labels))
    return f"CASE {parts} END"


def scored_ctes(max_chars: int | None = None) -> str:
    """CTEs ``messages``, ``clean`` and ``scored`` (lexicon scorer + heuristics).

    ``scored`` carries the PROCESSED fields except the map/time ones, plus
    ``scored_ok`` and ``value``."""
    w = SENTIMENT_WEIGHTS
    emo_logits = ",\n           ".join(
        f"CAST(neg_hits AS DOUBLE) * {a} + CAST(pos_hits AS DOUBLE) * {b} + {c} AS el{i}"
        for i, (a, b, c) in enumerate(EMOTION_WEIGHTS))
    emo_exp = ", ".join(f"exp(el{i} - greatest({', '.join(f'el{j}' for j in range(7))})) AS ee{i}"
                        for i in range(7))
    emo_tot = " + ".join(f"ee{i}" for i in range(7))
    emo_probs = ", ".join(f"ee{i} / ({emo_tot}) AS ep{i}" for i in range(7))
    emo_names = [f"ep{i}" for i in range(7)]
    ix = {lab: i for i, lab in enumerate(EMOTION_LABELS)}
    kw = " + ".join(f"(CASE WHEN contains(lower(text), '{k}') THEN 1 ELSE 0 END)"
                    for k in TOXIC_KEYWORDS)
    return f"""
messages AS ({messages_sql()}
),
clean AS (
  SELECT * FROM messages WHERE text IS NOT NULL AND text <> ''
),
tok AS (
  SELECT *, CASE WHEN length(text) BETWEEN 1 AND {max_chars or 'length(text)'}
                 THEN regexp_split_to_array(lower(text), '[^\\p{{L}}]+') END AS toks
  FROM clean
),
hits AS MATERIALIZED (
  SELECT *,
         CASE WHEN toks IS NOT NULL THEN len(list_filter(toks, lambda x: x IN ({_words(FIXTURE_NEGATIVE_WORDS)}))) END AS neg_hits,
         CASE WHEN toks IS NOT NULL THEN len(list_filter(toks, lambda x: x IN ({_words(FIXTURE_POSITIVE_WORDS)}))) END AS pos_hits
  FROM tok
),
logits AS (
  SELECT *,
         CAST(neg_hits AS DOUBLE) * {w['neg']} AS sl0, CAST({w['neutral_bias']} AS DOUBLE) AS sl1,
         CAST(pos_hits AS DOUBLE) * {w['pos']} AS sl2,
           {emo_logits}
  FROM hits
),
expd AS (
  SELECT *,
         exp(sl0 - greatest(sl0, sl1, sl2)) AS se0, exp(sl1 - greatest(sl0, sl1, sl2)) AS se1,
         exp(sl2 - greatest(sl0, sl1, sl2)) AS se2,
         {emo_exp}
  FROM logits
),
probs AS (
  SELECT *, se0 / (se0 + se1 + se2) AS sp0, se1 / (se0 + se1 + se2) AS sp1,
         se2 / (se0 + se1 + se2) AS sp2, {emo_probs}
  FROM expd
),
resp AS (
  SELECT *,
         (sp0 * -1.0 + sp1 * 0.0) + sp2 * 1.0 AS r_score,
         {_argmax_case(['sl0', 'sl1', 'sl2'], SENTIMENT_LABELS)} AS r_label,
         greatest(sp0, sp1, sp2) AS r_conf,
         {_argmax_case([f'el{i}' for i in range(7)], EMOTION_LABELS)} AS r_emotion,
         ({kw}) AS r_hits
  FROM probs
),
resp2 AS (
  SELECT *,
         least(((((CASE WHEN r_score < -0.5 THEN 0.3 ELSE 0.0 END)
                 + ep{ix['anger']} * 0.4) + ep{ix['disgust']} * 0.3) + ep{ix['fear']} * 0.1)
               + least(r_hits * 0.1, 0.3), 1.0) AS r_tox
  FROM resp
),
resp3 AS (
  SELECT *,
         least(((((CASE WHEN r_score < 0 THEN abs(r_score) * 0.5 ELSE 0.0 END)
                 + r_tox * 0.3) + ep{ix['anger']} * 0.4) + ep{ix['sadness']} * 0.2)
               + ep{ix['fear']} * 0.1, 1.0) AS r_churn
  FROM resp2
),
scored AS (
  SELECT id, doc_id, text, platform, author, timestamp, city, product, channel, device, language, source,
         value,
         toks IS NOT NULL AS scored_ok,
         CASE WHEN toks IS NOT NULL THEN r_score ELSE 0.0 END AS sentiment_score,
         CASE WHEN toks IS NOT NULL THEN r_label ELSE 'neutral' END AS sentiment_label,
         CASE WHEN toks IS NOT NULL THEN r_conf ELSE 0.0 END AS confidence,
         CASE WHEN toks IS NOT NULL THEN r_emotion ELSE 'neutral' END AS emotion,
         CASE WHEN toks IS NOT NULL THEN r_tox ELSE 0.0 END AS toxicity,
         CASE WHEN toks IS NOT NULL THEN r_churn ELSE 0.0 END AS churn_risk,
         {', '.join(f'CASE WHEN toks IS NOT NULL THEN ep{i} END AS emo_{lab}' for i, lab in enumerate(EMOTION_LABELS))},
         CASE WHEN toks IS NOT NULL THEN sp0 END AS p_negative,
         CASE WHEN toks IS NOT NULL THEN sp1 END AS p_neutral,
         CASE WHEN toks IS NOT NULL THEN sp2 END AS p_positive
  FROM resp3
)"""


def with_scored(body: str, max_chars: int | None = None) -> str:
    return "WITH " + scored_ctes(max_chars).lstrip() + "\n" + body


def with_messages(body: str) -> str:
    return f"WITH messages AS ({messages_sql()}\n)\n" + body


def metric_sql(digits: int | None = 6) -> str:
    """A1 in SQL; ``digits=None`` leaves the means unrounded."""
    def r(x):
        return f"round({x}, {digits})" if digits is not None else x
    return f"""count(*) AS count,
       {r('sum(coalesce(sentiment_score, 0.0)) / count(*)')} AS avg_sentiment,
       count(*) FILTER (WHERE sentiment_label = 'positive') AS positive_count,
       count(*) FILTER (WHERE sentiment_label = 'negative') AS negative_count,
       count(*) - count(*) FILTER (WHERE sentiment_label = 'positive')
                - count(*) FILTER (WHERE sentiment_label = 'negative') AS neutral_count,
       {r('sum(coalesce(churn_risk, 0.0)) / count(*)')} AS avg_churn_risk,
       count(*) FILTER (WHERE coalesce(churn_risk, 0.0) > 0.7) AS high_churn_count,
       {r('sum(coalesce(toxicity, 0.0)) / count(*)')} AS avg_toxicity"""


METRIC_SQL = metric_sql(6)
METRIC_SQL_RAW = metric_sql(None)
