"""The DuckDB twin of every query: plain SQL over the same parquet views.

Each statement names the relations it builds on; `_with` puts their definitions in front.
"""

from __future__ import annotations

import re

from ledgerlake.functions import lexicons
from ledgerlake.plans.queries import QUESTION


def _words(words) -> str:
    return ", ".join(f"'{w}'" for w in sorted(words))


def _tokens(text: str) -> str:
    return rf"list_filter(regexp_split_to_array(lower({text}), '[^\p{{L}}]+'), lambda t: t <> '')"


def _weight(label: str) -> str:
    cases = " ".join(f"WHEN '{w}' THEN {n}" for w, n in sorted(lexicons.PROSE_TOPICS[label].items()))
    return f"coalesce(list_sum(list_transform(tok, lambda t: CASE t {cases} ELSE 0 END)), 0)"


_POS = f"len(list_filter(tok, lambda t: t IN ({_words(lexicons.PROSE_POSITIVE)})))"
_NEG = f"len(list_filter(tok, lambda t: t IN ({_words(lexicons.PROSE_NEGATIVE)})))"
_BEST = "greatest(" + ", ".join(f"w{i}" for i in range(6)) + ")"
_TOPIC = (
    f"CASE WHEN {_BEST} <= 0 THEN 'Macroeconomy' "
    + " ".join(f"WHEN w{i} = {_BEST} THEN '{label}'" for i, label in enumerate(lexicons.TOPICS))
    + " END"
)

# Two-sided normal quantiles for 0.95 and 0.90.
Z95, Z90 = "1.959963984540054", "1.6448536269514722"
JOBS = "DATE '2024-02-20'"
LONG, TXN, MARKET = "DATE '2001-08-01'", "DATE '2024-01-31'", "DATE '2024-01-30'"


def _model(prefix: str, points: str) -> dict[str, tuple[list[str], str]]:
    """Relations of the trend plus weekday model fitted on `points` (series, ts, y)."""
    return {
        f"{prefix}_p": ([points], f"SELECT series, y, date_diff('day', DATE '1970-01-01', ts::DATE)::DOUBLE AS t, dayofweek(ts) AS dow FROM {points}"),
        f"{prefix}_l": ([f"{prefix}_p"], f"SELECT series, count(*) AS n, avg(t) AS tm, avg(y) AS ym, max(t) AS tl, coalesce(regr_sxx(y, t), 0) AS sxx, CASE WHEN var_pop(t) > 0 THEN regr_slope(y, t) ELSE 0 END AS b FROM {prefix}_p GROUP BY series"),
        f"{prefix}_d": ([f"{prefix}_l"], f"SELECT series, dow, count(*) AS k, avg(y - ym - b * (t - tm)) AS effect, var_pop(y - ym - b * (t - tm)) AS v FROM {prefix}_p JOIN {prefix}_l USING (series) GROUP BY series, dow"),
        f"{prefix}_m": ([f"{prefix}_d"], f"SELECT l.*, CASE WHEN l.n > 2 THEN sqrt(s.e / (l.n - 2)) ELSE 0 END AS sigma FROM {prefix}_l l JOIN (SELECT series, sum(k * v) AS e FROM {prefix}_d GROUP BY series) s USING (series)"),
    }


def _predict(prefix: str, at: str, z: str) -> str:
    """Band of the model at the points of `at` (series, ts, ...)."""
    return f"""
      SELECT a.*, ym + b * dt + coalesce(effect, 0) AS forecast,
             ym + b * dt + coalesce(effect, 0) - half AS lower_bound,
             ym + b * dt + coalesce(effect, 0) + half AS upper_bound
      FROM (SELECT x.*, m.ym, m.b, dayofweek(x.ts) AS dw, t - tm AS dt,
                   {z} * sigma * sqrt(1 + 1.0::DOUBLE / n + CASE WHEN sxx > 0 THEN (t - tm) * (t - tm) / sxx ELSE 0 END) AS half
            FROM (SELECT *, date_diff('day', DATE '1970-01-01', ts::DATE)::DOUBLE AS t FROM {at}) x
            JOIN {prefix}_m m USING (series)) a
      LEFT JOIN {prefix}_d d ON d.series = a.series AND d.dow = a.dw"""


RELATIONS: dict[str, tuple[list[str], str]] = {
    "ev": ([], r"SELECT *, regexp_extract(props, '\d+')::INTEGER AS k FROM events"),
    "txn": (["ev"], """
      SELECT event_id::VARCHAR AS txn_id, 'ACCT' || user_id AS account_id, ts AS txn_ts,
             round(value * 10, 2) AS amount, event_type AS category, 'Merchant ' || k AS merchant,
             'City ' || (user_id % 80) AS city,
             CASE WHEN k >= 10 THEN 'US' ELSE ['NG', 'RU', 'CN', 'BR', 'RO'][k % 5 + 1] END AS country,
             CASE WHEN k % 3 = 0 THEN 'online' ELSE 'in_store' END AS channel,
             k < 2 AS is_fraud_label
      FROM ev"""),
    "txn_s": (["txn"], "SELECT * REPLACE (date_trunc('second', txn_ts) AS txn_ts) FROM txn"),
    "longtxn": ([], """
      SELECT o_orderdate::DATE AS spend_date, c_mktsegment AS category, o_totalprice AS amount
      FROM orders JOIN customer ON o_custkey = c_custkey JOIN nation ON c_nationkey = n_nationkey"""),
    "polled": ([], """
      SELECT *, greatest(open, close) AS high, least(open, close) AS low
      FROM (SELECT event_type AS ticker, date_trunc('second', ts) AS ts, value AS open,
                   round(value * (1 + ((event_id % 7) - 3) / 100::DOUBLE), 4) AS close,
                   user_id + 1 AS volume, event_id, ts AS ingested_at
            FROM events
            QUALIFY row_number() OVER (PARTITION BY event_type, date_trunc('second', ts) ORDER BY event_id DESC) = 1)"""),
    "bars": ([], """
      SELECT *, greatest(open, close) AS high, least(open, close) AS low
      FROM (SELECT event_type AS ticker, ts, value AS open, round(value * (1 + ((event_id % 7) - 3) / 100::DOUBLE), 4) AS close,
                   user_id + 1 AS volume, event_id, ts AS ingested_at FROM events)"""),
    "ohlc": (["bars"], """
      SELECT ticker, ts::DATE AS trade_date, arg_min(open, ts) AS open, max(high) AS high, min(low) AS low,
             arg_max(close, ts) AS close, sum(volume)::BIGINT AS volume
      FROM bars GROUP BY ALL"""),
    "daily": (["ohlc"], """
      SELECT *, close / nullif(lag(close) OVER (PARTITION BY ticker ORDER BY trade_date), 0) - 1 AS daily_return
      FROM ohlc"""),
    "prev": (["ohlc"], f"SELECT ticker, arg_max(close, trade_date) AS prev_close FROM ohlc WHERE trade_date < {MARKET} GROUP BY ticker"),
    "latest": (["bars", "prev"], """
      SELECT b.ticker, close AS last_price, prev_close, close - prev_close AS day_change,
             CASE WHEN prev_close = 0 THEN 0 ELSE (close - prev_close) / prev_close END * 100 AS day_change_pct,
             volume AS last_volume, ts AS as_of
      FROM (SELECT * FROM bars WHERE (ticker, ts) IN (SELECT (ticker, max(ts)) FROM bars GROUP BY ticker)) b
      LEFT JOIN prev p ON p.ticker = b.ticker"""),
    "moved": (["latest"], """
      SELECT 'gainer' AS side, row_number() OVER (ORDER BY day_change_pct DESC NULLS LAST, ticker)::INTEGER AS rank, ticker, round(day_change_pct, 2) AS pct
      FROM latest QUALIFY rank <= 3
      UNION ALL
      SELECT 'loser', row_number() OVER (ORDER BY day_change_pct ASC NULLS LAST, ticker)::INTEGER AS rank, ticker, round(day_change_pct, 2)
      FROM latest QUALIFY rank <= 3"""),
    "spend": (["longtxn"], "SELECT spend_date, count(*) AS txn_count, sum(amount) AS total_spend, avg(amount) AS avg_ticket FROM longtxn GROUP BY spend_date"),
    "bycat": (["longtxn"], "SELECT spend_date, category, count(*) AS txn_count, sum(amount) AS total_spend FROM longtxn GROUP BY ALL"),
    "kpis": (["spend"], f"""
      SELECT a.s AS spend_30d, a.n AS txns_30d, a.t AS avg_ticket_30d,
             CASE WHEN p.s = 0 THEN 0 ELSE (a.s - p.s) / p.s END * 100 AS spend_mom_pct
      FROM (SELECT sum(total_spend) AS s, sum(txn_count)::BIGINT AS n, avg(avg_ticket) AS t FROM spend WHERE spend_date >= {LONG} - 30) a,
           (SELECT sum(total_spend) AS s FROM spend WHERE spend_date >= {LONG} - 60 AND spend_date < {LONG} - 30) p"""),
    "feat": (["txn"], """
      SELECT *, hour(txn_ts)::INTEGER AS txn_hour, dayofweek(txn_ts)::INTEGER AS txn_dow,
             sum(amount::DECIMAL(28, 2)) OVER (PARTITION BY account_id)::DOUBLE
               / count(amount) OVER (PARTITION BY account_id) AS acct_avg_amount,
             amount / nullif(sum(amount::DECIMAL(28, 2)) OVER (PARTITION BY account_id, category)::DOUBLE
               / count(amount) OVER (PARTITION BY account_id, category), 0) AS amt_vs_cat_avg,
             merchant || ' | ' || category || ' | ' || city || ', ' || country || ' | ' || channel AS txn_text
      FROM txn"""),
    "cand": (["feat"], """
      SELECT *, (coalesce(amt_vs_cat_avg > 4, false)::INTEGER + (amount > 1000)::INTEGER
                 + (channel = 'online' AND country <> 'US')::INTEGER + (txn_hour < 5)::INTEGER
                 + is_fraud_label::INTEGER)::INTEGER AS rule_score
      FROM feat"""),
    "scored": (["cand"], """
      SELECT *, CASE WHEN rule_score >= 3 THEN 'Suspicious' ELSE 'Legitimate' END AS ai_fraud_class
      FROM (SELECT * FROM cand WHERE rule_score >= 1 ORDER BY rule_score DESC, txn_ts DESC, txn_id LIMIT 200)"""),
    "explained": (["scored"], """
      SELECT *, 'Suspicious: ' || concat_ws('; ',
               CASE WHEN amt_vs_cat_avg > 4 THEN printf('%.1f', round(amt_vs_cat_avg, 1)) || 'x the usual ' || category || ' spend' END,
               CASE WHEN amount > 1000 THEN 'amount $' || printf('%.2f', amount) END,
               CASE WHEN channel = 'online' AND country <> 'US' THEN 'online from ' || country END,
               CASE WHEN txn_hour < 5 THEN 'at hour ' || txn_hour END,
               CASE WHEN is_fraud_label THEN 'labelled as fraud' END)
             || '. Action: ' ||
             CASE WHEN amt_vs_cat_avg > 4 AND amount > 1000 THEN 'Block the card and call the cardholder.'
                  WHEN channel = 'online' AND country <> 'US' THEN 'Decline and ask for step-up verification.'
                  WHEN txn_hour < 5 THEN 'Hold the transaction for manual review.'
                  ELSE 'Monitor the account.' END AS ai_reason
      FROM scored WHERE ai_fraud_class = 'Suspicious'"""),
    # series
    "spend_y": (["spend"], "SELECT 'spend' AS series, spend_date::TIMESTAMP AS ts, total_spend AS y FROM spend"),
    "ship_y": ([], "SELECT l_returnflag AS series, l_shipdate AS ts, sum(l_quantity) AS y FROM lineitem GROUP BY ALL"),
    "price_y": (["ohlc"], "SELECT ticker AS series, trade_date::TIMESTAMP AS ts, close AS y FROM ohlc WHERE close IS NOT NULL"),
    "spend_tr": (["spend_y"], f"SELECT * FROM spend_y WHERE ts < {LONG} - 30"),
    "ship_tr": (["ship_y"], f"SELECT * FROM ship_y WHERE ts < {LONG} - 30"),
    "spend_ev": (["spend_y"], f"SELECT * FROM spend_y WHERE ts >= {LONG} - 30"),
    "ship_ev": (["ship_y"], f"SELECT * FROM ship_y WHERE ts >= {LONG} - 30"),
    "d": ([], "SELECT DISTINCT ts::DATE AS day FROM events"),
    "vol_y": (["ohlc"], "SELECT ticker AS series, trade_date::TIMESTAMP AS ts, volume::DOUBLE AS y FROM ohlc"),
    "vol_tr": (["vol_y"], f"SELECT * FROM vol_y WHERE ts < {JOBS} - 30"),
    "vol_ev": (["vol_y"], f"SELECT * FROM vol_y WHERE ts >= {JOBS} - 30"),
    **_model("wa", "vol_tr"),
    "wa_out": (["wa_m", "vol_ev"], f"SELECT *, y < lower_bound OR y > upper_bound AS is_anomaly FROM ({_predict('wa', 'vol_ev', Z95)})"),
    **_model("sa", "spend_tr"),
    **_model("va", "ship_tr"),
    **_model("sf", "spend_y"),
    **_model("pf", "price_y"),
    "sf_at": (["sf_m"], "SELECT series, (DATE '1970-01-01' + tl::INTEGER + h::INTEGER)::TIMESTAMP AS ts FROM sf_m, range(1, 15) r(h)"),
    "pf_at": (["pf_m"], "SELECT series, (DATE '1970-01-01' + tl::INTEGER + h::INTEGER)::TIMESTAMP AS ts FROM pf_m, range(1, 8) r(h)"),
    "sa_out": (["sa_m", "spend_ev"], f"SELECT *, y < lower_bound OR y > upper_bound AS is_anomaly FROM ({_predict('sa', 'spend_ev', Z95)})"),
    "va_out": (["va_m", "ship_ev"], f"SELECT *, y < lower_bound OR y > upper_bound AS is_anomaly FROM ({_predict('va', 'ship_ev', Z95)})"),
    "sf_out": (["sf_at"], _predict("sf", "sf_at", Z90)),
    "pf_out": (["pf_at"], _predict("pf", "pf_at", Z90)),
    # news
    "news": ([], """
      SELECT doc_id::VARCHAR AS news_id, TIMESTAMP '2024-01-01' + to_days((doc_id % 30)::INTEGER) AS published_at,
             ['click', 'error', 'purchase', 'signup', 'view'][doc_id % 5 + 1] AS ticker,
             split_part(text, chr(10), 1) AS headline, text AS body, source
      FROM documents"""),
    "ntok": (["news"], f"SELECT *, {_tokens(chr(39).join(['headline || ', '. ', ' || body']))} AS tok FROM news"),
    "nscore": (["ntok"], f"SELECT *, {_POS} AS p, {_NEG} AS q, " + ", ".join(f"{_weight(label)} AS w{i}" for i, label in enumerate(lexicons.TOPICS)) + " FROM ntok"),
    "mood": (["nscore"], f"""
      SELECT *, CASE WHEN sentiment_score > 0.2 THEN 'Positive' WHEN sentiment_score < -0.2 THEN 'Negative' ELSE 'Neutral' END AS sentiment_label
      FROM (SELECT news_id, published_at, ticker, headline, body, source,
                   CASE WHEN p + q = 0 THEN 0 ELSE (p - q)::DOUBLE / (p + q) END AS sentiment_score, {_TOPIC} AS topic
            FROM nscore)"""),
    "sent": (["news"], r"""
      SELECT news_id, unnest(s) AS sentence, generate_subscripts(s, 1) AS pos
      FROM (SELECT news_id, regexp_extract_all(body, '[^.!?\n]+[.!?]?') AS s FROM news)"""),
    "swords": (["sent"], f"SELECT news_id, pos, unnest({_tokens('sentence')}) AS term FROM sent"),
    "summ": (["swords"], """
      SELECT news_id, trim(sentence) AS summary FROM sent JOIN (
        SELECT news_id, pos FROM (
          SELECT news_id, pos, round(avg(tf), 6) AS score
          FROM swords JOIN (SELECT news_id, term, count(*) AS tf FROM swords GROUP BY ALL) USING (news_id, term)
          GROUP BY news_id, pos)
        QUALIFY row_number() OVER (PARTITION BY news_id ORDER BY score DESC, pos) = 1) USING (news_id, pos)"""),
    "enriched": (["mood", "summ"], "SELECT m.news_id, published_at, ticker, headline, body, source, sentiment_score, topic, summary, sentiment_label FROM mood m LEFT JOIN summ s USING (news_id)"),
    "moodday": (["mood"], "SELECT ticker, published_at::DATE AS d, avg(sentiment_score) AS avg_sentiment FROM mood GROUP BY ALL"),
    # themes
    "hterm": (["news"], f"SELECT ticker, news_id, published_at, headline, unnest(list_distinct({_tokens('headline')})) AS term FROM news"),
    "tw": (["hterm"], """
      SELECT ticker, term, round(tf * ln(1 + (SELECT count(*) FROM news) / df::DOUBLE), 6) AS weight
      FROM (SELECT ticker, term, count(*) AS tf FROM hterm GROUP BY ALL) JOIN (SELECT term, count(*) AS df FROM hterm GROUP BY term) USING (term)"""),
    "tops": (["tw"], "SELECT *, row_number() OVER (PARTITION BY ticker ORDER BY weight DESC, term) AS r FROM tw QUALIFY r <= 3"),
    "central": (["tops"], """
      SELECT n.ticker, n.headline, row_number() OVER (PARTITION BY n.ticker ORDER BY round(coalesce(c.w, 0), 6) DESC, n.published_at DESC, n.news_id) AS r
      FROM news n LEFT JOIN (SELECT h.news_id, sum(weight) AS w FROM hterm h JOIN tops t ON t.ticker = h.ticker AND t.term = h.term GROUP BY h.news_id) c USING (news_id)
      QUALIFY r <= 2"""),
    "themestat": (["mood"], "SELECT ticker, count(*) AS articles, round(avg(sentiment_score), 3) AS avg_sentiment FROM mood GROUP BY ticker"),
    "themes": (["central", "themestat"], """
      SELECT s.*, 'Coverage turns on ' || (SELECT string_agg(term, ', ' ORDER BY r) FROM tops t WHERE t.ticker = s.ticker)
                  || '. Leading headlines: ' || (SELECT string_agg(headline, '; ' ORDER BY r) FROM central c WHERE c.ticker = s.ticker) || '.' AS narrative
      FROM themestat s"""),
    # search
    "ptok": (["news"], f"SELECT news_id, ticker, {_tokens('body')} AS tok FROM news"),
    "dl": (["ptok"], "SELECT news_id, ticker, len(tok) AS dl FROM ptok"),
    "post": (["dl"], "SELECT news_id, term, count(*) AS tf FROM (SELECT news_id, unnest(tok) AS term FROM ptok) GROUP BY ALL"),
    "idf": (["post"], "SELECT term, ln(1 + ((SELECT count(*) FROM dl) - count(*) + 0.5::DOUBLE) / (count(*) + 0.5::DOUBLE)) AS idf FROM post GROUP BY term"),
    "ask": ([], f"SELECT DISTINCT item_id::VARCHAR AS query_id, unnest({_tokens('text')}) AS term FROM benchmark"),
    "bm": (["idf", "ask"], """
      SELECT query_id, news_id, round(sum(idf * tf * 2.2::DOUBLE / (tf + 1.2::DOUBLE * (0.25::DOUBLE + 0.75::DOUBLE * dl / (SELECT avg(dl) FROM dl)))), 6) AS score
      FROM ask JOIN post USING (term) JOIN idf USING (term) JOIN dl USING (news_id) GROUP BY ALL"""),
    # vectors
    "pool": (["scored"], """
      SELECT txn_id, txn_text, amount, category, merchant, city, country, channel, is_fraud_label FROM scored
      UNION
      SELECT txn_id, txn_text, amount, category, merchant, city, country, channel, is_fraud_label
      FROM (SELECT * FROM feat ORDER BY md5(txn_id), txn_id LIMIT 1000)"""),
    "slots": (["feat"], f"""
      SELECT txn_id, slot, sum(sgn) AS v FROM (
        SELECT txn_id, h % 768 AS slot, CASE WHEN (h // 768) % 2 = 0 THEN 1 ELSE -1 END AS sgn
        FROM (SELECT txn_id, ('0x' || substr(md5(t), 1, 8))::BIGINT AS h
              FROM (SELECT txn_id, unnest({_tokens('txn_text')}) AS t FROM feat)))
      GROUP BY ALL HAVING sum(sgn) <> 0"""),
    "vec": (["slots"], "SELECT txn_id, slot, (v / sqrt(sum(v * v) OVER (PARTITION BY txn_id)))::FLOAT::DOUBLE AS v FROM slots"),
    "vlen": (["vec"], "SELECT txn_id, sqrt(sum(v * v)) AS len FROM vec GROUP BY txn_id"),
}


def _near(targets: str, corpus: str) -> str:
    """Top 5 of a corpus (txn_id) for the targets (target_id) by cosine of the hashed vectors."""
    return f"""
      SELECT target_id, txn_id, similarity, row_number() OVER (PARTITION BY target_id ORDER BY similarity DESC, txn_id)::INTEGER AS rank
      FROM (SELECT a.target_id, b.txn_id, round(sum(a.v * b.v) / (any_value(a.len) * any_value(b.len)), 6) AS similarity
            FROM (SELECT target_id, slot, v, len FROM {targets} t JOIN vec ON vec.txn_id = t.target_id JOIN vlen ON vlen.txn_id = t.target_id) a
            JOIN (SELECT vec.txn_id, slot, v, len FROM {corpus} c JOIN vec ON vec.txn_id = c.txn_id JOIN vlen ON vlen.txn_id = c.txn_id) b
              ON a.slot = b.slot AND a.target_id <> b.txn_id
            GROUP BY a.target_id, b.txn_id)
      QUALIFY rank <= 5"""


def _with(names: list[str], select: str) -> str:
    done: dict[str, str] = {}

    def add(name: str) -> None:
        if name in done:
            return
        needs, body = RELATIONS[name]
        for n in needs:
            add(n)
        done[name] = body

    for n in names:
        add(n)
    return ("WITH " + ",\n".join(f"{k} AS MATERIALIZED ({v})" for k, v in done.items()) + "\n" if done else "") + select


# The features of what the chained refresh keeps: whole seconds, without the malformed lines.
RELATIONS["feat_s"] = (["txn_s"], RELATIONS["feat"][1].replace("FROM txn", "FROM (SELECT * FROM txn_s WHERE merchant <> 'Merchant 99')"))

# The job chain: transactions in whole seconds, candles of the last poll that has a close.
for _name in ("feat", "cand", "scored", "explained"):
    _needs, _body = RELATIONS[_name]
    for _old in ("txn", "feat", "cand", "scored"):
        _body = re.sub(rf"\bFROM {_old}\b", "FROM " + ("txn_s" if _old == "txn" else f"j{_old}"), _body)
    RELATIONS[f"j{_name}"] = (["txn_s" if n == "txn" else f"j{n}" for n in _needs], _body)
RELATIONS |= {
    "jbars": (["polled"], "SELECT * REPLACE (CASE WHEN day(ts) % 2 = 0 AND event_id % 11 <> 0 THEN round(close + 0.5, 4) ELSE close END AS close) FROM polled"),
    "johlc": (["jbars"], RELATIONS["ohlc"][1].replace("FROM bars", "FROM jbars")),
    "jlatest": (["johlc"], f"""
      SELECT * FROM (SELECT ticker, close, volume FROM jbars QUALIFY row_number() OVER (PARTITION BY ticker ORDER BY ts DESC) = 1)
      JOIN (SELECT ticker, arg_max(close, trade_date) AS prev_close FROM johlc WHERE trade_date < {JOBS} GROUP BY ticker) USING (ticker)"""),
    "jspend": (["txn_s"], "SELECT txn_ts::DATE AS spend_date, count(*) AS txn_count, sum(amount) AS total_spend, avg(amount) AS avg_ticket FROM txn_s GROUP BY 1"),
    "jkpis": (["jspend"], RELATIONS["kpis"][1].replace(LONG, JOBS).replace("FROM spend", "FROM jspend")),
    "jspend_y": (["jspend"], RELATIONS["spend_y"][1].replace("FROM spend", "FROM jspend")),
    "jprice_y": (["johlc"], RELATIONS["price_y"][1].replace("FROM ohlc", "FROM johlc")),
    "jvol_y": (["johlc"], RELATIONS["vol_y"][1].replace("FROM ohlc", "FROM johlc")),
    **{f"j{s}_{part}": ([f"j{s}_y"], f"SELECT * FROM j{s}_y WHERE ts {sign} {JOBS} - 30") for s in ("spend", "vol") for part, sign in (("tr", "<"), ("ev", ">="))},
    **_model("js", "jspend_tr"), **_model("jv", "jvol_tr"), **_model("jf", "jspend_y"), **_model("jp", "jprice_y"),
    "js_out": (["js_m", "jspend_ev"], _predict("js", "jspend_ev", Z95)),
    "jv_out": (["jv_m", "jvol_ev"], _predict("jv", "jvol_ev", Z95)),
    **{f"{p}_at": ([f"{p}_m"], RELATIONS[f"{old}_at"][1].replace(f"{old}_m", f"{p}_m")) for p, old in (("jf", "sf"), ("jp", "pf"))},
    "jf_out": (["jf_at"], _predict("jf", "jf_at", Z90)),
    "jp_out": (["jp_at"], _predict("jp", "jp_at", Z90)),
}

_FEAT = "* REPLACE (round(acct_avg_amount, 8) AS acct_avg_amount, round(amt_vs_cat_avg, 6) AS amt_vs_cat_avg)"
_BAND = "round(forecast, 3) AS forecast, round(lower_bound, 3) AS lower_bound, round(upper_bound, 3) AS upper_bound"
_BAND5 = _BAND.replace(", 3)", ", 5)")

_STATEMENTS: dict[str, tuple[list[str], str]] = {
    "market_bars_flatten": (["polled"], """
      SELECT ticker, ts, open, high, low,
             CASE WHEN day(ts) % 2 = 0 AND event_id % 11 <> 0 THEN round(close + 0.5, 4) ELSE close END AS close, volume
      FROM polled"""),
    "land_market_by_ticker": (["polled"], """
      SELECT upper(ticker) AS ticker, 'backfill' AS source, count(*) AS payloads, sum(c)::BIGINT AS candles
      FROM (SELECT ticker, ts::DATE AS d, count(*) AS c FROM polled GROUP BY ALL
            UNION ALL SELECT ticker, ts::DATE, count(*) FROM polled WHERE day(ts) % 2 = 0 GROUP BY ALL)
      WHERE ticker IN ('click', 'view', 'purchase') GROUP BY ticker"""),
    "read_json_records": (["txn_s"], "SELECT * FROM txn_s WHERE merchant <> 'Merchant 99' UNION ALL SELECT * FROM txn_s WHERE merchant = 'Merchant 0'"),
    "quarantine_bad": (["txn"], """SELECT '{"txn_id": "' || txn_id || '", "amount": ' AS text FROM txn WHERE merchant = 'Merchant 99'"""),
    "silver_transactions": (["txn_s"], "SELECT * REPLACE (CASE WHEN regexp_extract(merchant, '\\d+')::INTEGER < 50 THEN round(amount + 1, 2) ELSE amount END AS amount) FROM txn_s"),
    "silver_news": (["news"], "SELECT * REPLACE (CASE WHEN ticker = 'view' THEN upper(source) ELSE source END AS source) FROM news"),
    "gold_news": (["news"], "SELECT * FROM news"),
    "ohlc_daily": (["ohlc"], "SELECT * FROM ohlc"),
    "daily_return": (["daily"], "SELECT * REPLACE (round(daily_return, 8) AS daily_return) FROM daily"),
    "market_latest": (["latest"], "SELECT * REPLACE (round(day_change, 4) AS day_change, round(day_change_pct, 6) AS day_change_pct) FROM latest"),
    "prev_close": (["prev"], "SELECT * FROM prev"),
    "market_intraday": (["bars"], "SELECT ticker, ts, open, high, low, close, volume FROM bars"),
    "breadth": (["latest"], "SELECT count_if(coalesce(day_change_pct, 0) >= 0)::BIGINT AS advancers, count(*) AS total FROM latest"),
    "movers": (["moved"], "SELECT * FROM moved"),
    "candles": (["ohlc"], "SELECT trade_date, open, high, low, close, volume, open <= close AS up FROM ohlc WHERE ticker = 'purchase'"),
    "returns_heatmap": (["daily"], "SELECT ticker, trade_date, round(daily_return, 8) AS daily_return FROM daily WHERE daily_return IS NOT NULL"),
    "tickers": ([], "SELECT DISTINCT event_type AS ticker FROM events"),
    "newest_rows": (["bars"], "SELECT ticker, ingested_at, event_id FROM bars ORDER BY ingested_at DESC, event_id LIMIT 10"),
    "compound_index": (["daily"], """
      SELECT ticker, trade_date, round(daily_return, 8) AS daily_return,
             round(ln(100 * exp(sum(daily_return) OVER (PARTITION BY ticker ORDER BY trade_date ROWS UNBOUNDED PRECEDING))), 6) AS log_level
      FROM daily"""),
    "densify_returns": (["daily"], """
      SELECT t.ticker, d::DATE AS d, round(coalesce(daily_return, 0), 8) AS ret
      FROM (SELECT DISTINCT ticker FROM daily) t
      CROSS JOIN (SELECT unnest(generate_series(min(ts)::DATE, max(ts)::DATE, INTERVAL 1 DAY)) AS d FROM bars) s
      LEFT JOIN daily y ON y.ticker = t.ticker AND y.trade_date = s.d::DATE"""),
    "code_labels": ([], """
      SELECT label, n, base FROM (
        SELECT CASE event_type WHEN 'click' THEN 'Browse' WHEN 'view' THEN 'Browse' WHEN 'error' THEN 'Failure'
                               WHEN 'purchase' THEN 'Order' WHEN 'signup' THEN 'Account' ELSE 'Other' END AS label, count(*) AS n
        FROM events GROUP BY label)
      JOIN (VALUES ('Browse', 1.0::DOUBLE), ('Failure', 2.0), ('Order', 3.0), ('Account', 4.0)) v(label, base) USING (label)"""),
    "spend_daily": (["spend"], "SELECT spend_date, txn_count, round(total_spend, 2) AS total_spend, round(avg_ticket, 6) AS avg_ticket FROM spend"),
    "spend_by_category": (["bycat"], "SELECT spend_date, category, txn_count, round(total_spend, 2) AS total_spend FROM bycat"),
    "category_share": (["bycat"], f"SELECT category, round(sum(total_spend), 2) AS total_spend, sum(txn_count)::BIGINT AS txn_count FROM bycat WHERE spend_date >= {LONG} - 30 GROUP BY category"),
    "category_trend": (["bycat"], "SELECT spend_date, category, round(total_spend, 2) AS total_spend FROM bycat"),
    "spend_kpis": (["kpis"], "SELECT round(spend_30d, 2) AS spend_30d, txns_30d, round(avg_ticket_30d, 4) AS avg_ticket_30d, round(spend_mom_pct, 6) AS spend_mom_pct FROM kpis"),
    "daily_avg_spend": (["kpis"], "SELECT round(coalesce(spend_30d, 0) / 30, 2) AS daily_avg_spend FROM kpis"),
    "spend_trend": (["spend"], "SELECT spend_date, round(total_spend, 2) AS total_spend, txn_count, round(avg_ticket, 6) AS avg_ticket FROM spend"),
    "txn_features": (["feat"], f"SELECT {_FEAT} FROM feat"),
    "fraud_candidates": (["cand"], f"SELECT {_FEAT} FROM cand"),
    "fraud_scored": (["scored"], f"SELECT {_FEAT} FROM scored"),
    "fraud_explained": (["explained"], f"SELECT {_FEAT} FROM explained"),
    "fraud_flagged": (["explained"], "SELECT txn_id, txn_ts, account_id, amount, category, merchant, city, country, channel, round(amt_vs_cat_avg, 1) AS x_usual, rule_score, ai_reason FROM explained"),
    "fraud_class_counts": (["scored"], "SELECT ai_fraud_class, count(*) AS n FROM scored GROUP BY ai_fraud_class"),
    "fraud_class_share": (["scored"], "SELECT count_if(ai_fraud_class = 'Suspicious')::BIGINT AS suspicious, count(*) AS total, round(100.0::DOUBLE * count_if(ai_fraud_class = 'Suspicious') / count(*), 4) AS suspicious_pct FROM scored"),
    "spend_anomalies": (["sa_out"], f"SELECT series, ts, round(y, 2) AS y, {_BAND}, is_anomaly FROM sa_out"),
    "volume_anomalies": (["va_out"], f"SELECT series, ts, y, {_BAND}, is_anomaly FROM va_out"),
    "spend_anomaly_view": (["sa_out"], "SELECT ts::DATE AS day, round(y, 2) AS actual_spend, round(forecast, 3) AS expected_spend, round(lower_bound, 3) AS lower_bound, round(upper_bound, 3) AS upper_bound, is_anomaly FROM sa_out"),
    "volume_anomaly_view": (["va_out"], "SELECT series AS ticker, ts::DATE AS day, y AS actual_volume, round(forecast, 3) AS expected_volume, is_anomaly FROM va_out WHERE is_anomaly"),
    "anomaly_counts": (["sa_out", "va_out"], "SELECT 'spend' AS kind, count_if(is_anomaly)::BIGINT AS anomalies, count(*) AS points FROM sa_out UNION ALL SELECT 'volume', count_if(is_anomaly)::BIGINT, count(*) FROM va_out"),
    "spend_forecast": (["sf_out"], f"SELECT ts AS forecast_date, {_BAND} FROM sf_out"),
    "price_forecast": (["pf_out"], f"SELECT series AS ticker, ts AS forecast_date, {_BAND5} FROM pf_out"),
    "history_and_forecast": (["pf_out"], """
      SELECT 'actual' AS kind, series, ts AS d, round(y, 5) AS y, NULL::DOUBLE AS lower_bound, NULL::DOUBLE AS upper_bound FROM price_y WHERE series = 'view'
      UNION ALL SELECT 'forecast', series, ts, round(forecast, 5), round(lower_bound, 5), round(upper_bound, 5) FROM pf_out WHERE series = 'view'"""),
    "news_sentiment": (["mood"], "SELECT news_id, round(sentiment_score, 6) AS sentiment_score, sentiment_label FROM mood"),
    "news_topic": (["mood"], "SELECT news_id, topic FROM mood"),
    "news_summary": (["summ"], "SELECT * FROM summ"),
    "news_enriched": (["enriched"], "SELECT * REPLACE (round(sentiment_score, 6) AS sentiment_score) FROM enriched"),
    "sentiment_daily": (["moodday"], "SELECT ticker, d, round(avg_sentiment, 6) AS avg_sentiment FROM moodday"),
    "sentiment_summary": (["mood"], "SELECT sentiment_label, count(*) AS n, round(avg(sentiment_score), 3) AS avg_score FROM mood GROUP BY sentiment_label"),
    "sentiment_mix": (["mood"], "SELECT sentiment_label, count(*) AS n FROM (SELECT * FROM mood ORDER BY published_at DESC, news_id LIMIT 200) GROUP BY sentiment_label"),
    "news_feed": (["enriched"], "SELECT published_at, ticker, headline, summary, sentiment_label, round(sentiment_score, 6) AS sentiment_score FROM enriched"),
    "price_vs_sentiment": (["ohlc", "moodday"], "SELECT o.ticker, trade_date, close, round(avg_sentiment, 6) AS avg_sentiment FROM ohlc o LEFT JOIN moodday m ON m.ticker = o.ticker AND m.d = o.trade_date"),
    "theme_stats": (["themestat"], "SELECT * FROM themestat"),
    "news_themes": (["themes"], "SELECT * FROM themes"),
    "news_search": (["bm", "mood"], """
      SELECT query_id, rank, b.news_id, score, headline, ticker, published_at, sentiment_label
      FROM (SELECT *, row_number() OVER (PARTITION BY query_id ORDER BY score DESC, news_id)::INTEGER AS rank FROM bm QUALIFY rank <= 5) b
      JOIN mood USING (news_id)"""),
    "news_search_all": (["bm"], """
      SELECT query_id, rank, b.news_id, score, ticker
      FROM (SELECT *, row_number() OVER (PARTITION BY query_id ORDER BY score DESC, news_id)::INTEGER AS rank FROM bm QUALIFY rank <= 5) b
      JOIN news USING (news_id)"""),
    "stream_index": (["bm"], """
      SELECT query_id, rank, b.news_id, score, ticker
      FROM (SELECT *, row_number() OVER (PARTITION BY query_id ORDER BY score DESC, news_id)::INTEGER AS rank FROM bm QUALIFY rank <= 3) b
      JOIN news USING (news_id)"""),
    "movers_with_news": (["moved", "idf"], f"""
      SELECT ticker, pct, news_rank, news_id, score, headline
      FROM (SELECT m.ticker, m.pct, s.news_id, s.score, row_number() OVER (PARTITION BY m.ticker ORDER BY s.score DESC, s.news_id)::INTEGER AS news_rank
            FROM (SELECT * FROM moved WHERE side = 'loser') m JOIN (
              SELECT ticker, news_id, round(sum(idf * tf * 2.2::DOUBLE / (tf + 1.2::DOUBLE * (0.25::DOUBLE + 0.75::DOUBLE * dl / (SELECT avg(dl) FROM dl)))), 6) AS score
              FROM (SELECT DISTINCT unnest({_tokens(f"'{QUESTION}'")}) AS term) JOIN post USING (term) JOIN idf USING (term) JOIN dl USING (news_id)
              GROUP BY ticker, news_id) s ON s.ticker = m.ticker QUALIFY news_rank <= 5)
      JOIN (SELECT news_id, headline FROM news) USING (news_id)"""),
    "vector_pool": (["pool"], "SELECT * FROM pool"),
    "embed_text": (["vec"], """
      SELECT txn_id, 768 AS dims, count(*)::INTEGER AS used, round(greatest(max(v), 0), 5) AS hi, round(least(min(v), 0), 5) AS lo,
             CASE WHEN max(v) > 0 THEN arg_max(slot, struct_pack(a := v, b := -slot)) + 1
                  WHEN min(slot) > 0 THEN 1 ELSE 2 END::BIGINT AS hi_at
      FROM vec GROUP BY txn_id"""),
    "similar_vectors": ([], """
      SELECT target_id, vec_id, similarity, rank, label FROM (
        SELECT a.vec_id AS target_id, b.vec_id, b.label, round(list_cosine_similarity(a.embedding::DOUBLE[], b.embedding::DOUBLE[]), 6) AS similarity,
               row_number() OVER (PARTITION BY a.vec_id ORDER BY round(list_cosine_similarity(a.embedding::DOUBLE[], b.embedding::DOUBLE[]), 6) DESC, b.vec_id)::INTEGER AS rank
        FROM embeddings a JOIN embeddings b ON a.vec_id <> b.vec_id
        WHERE a.vec_id IN (SELECT min(vec_id) FROM embeddings GROUP BY label))
      WHERE rank <= 5"""),
    "similar_transactions": (["vlen", "scored"], f"""
      SELECT n.*, f.txn_text, f.amount, f.category, f.is_fraud_label
      FROM ({_near("(SELECT txn_id AS target_id FROM scored WHERE ai_fraud_class = 'Suspicious')", "feat")}) n JOIN feat f USING (txn_id)"""),
    "quarantine_typed": (["ev", "txn"], """
      SELECT txn_id AS record_key, 'amount' AS field, 'many' AS value FROM txn WHERE regexp_extract(merchant, '\\d+')::INTEGER < 10 OR regexp_extract(merchant, '\\d+')::INTEGER BETWEEN 20 AND 29
      UNION ALL SELECT txn_id, 'txn_ts', 'soon' FROM txn WHERE regexp_extract(merchant, '\\d+')::INTEGER BETWEEN 10 AND 19
      UNION ALL SELECT txn_id, 'is_fraud_label', 'perhaps' FROM txn WHERE regexp_extract(merchant, '\\d+')::INTEGER BETWEEN 20 AND 29
      UNION ALL SELECT NULL, '_corrupt_record', left('{"txn_id":"' || txn_id || '","account_id":"' || account_id || '","ts":"', 30) FROM txn WHERE merchant = 'Merchant 99'
      UNION ALL SELECT txn_id, '(typed)', CASE WHEN regexp_extract(merchant, '\\d+')::INTEGER < 10 OR regexp_extract(merchant, '\\d+')::INTEGER BETWEEN 20 AND 29 THEN 'null' ELSE 'number' END
      FROM txn WHERE merchant <> 'Merchant 99'"""),
    "incremental_forecast": (["pf_out"], f"SELECT series AS ticker, ts AS forecast_date, {_BAND5} FROM pf_out"),
    "incremental_anomalies": (["sa_out"], f"SELECT series, ts, round(y, 2) AS y, {_BAND}, is_anomaly FROM sa_out"),
    "audit_metadata": (["ohlc", "spend", "bycat", "feat"], """
      SELECT 'market_daily' AS t, count(*) AS n_rows, min(trade_date)::VARCHAR AS lo, max(trade_date)::VARCHAR AS hi FROM ohlc
      UNION ALL SELECT 'spend_daily', count(*), min(spend_date)::VARCHAR, max(spend_date)::VARCHAR FROM spend
      UNION ALL SELECT 'spend_by_category', count(*), min(spend_date)::VARCHAR, max(spend_date)::VARCHAR FROM bycat
      UNION ALL SELECT 'txn_features', count(*), min(txn_ts::DATE)::VARCHAR, max(txn_ts::DATE)::VARCHAR FROM feat"""),
    "similar_candidates": (["vlen", "scored"], _near("(SELECT txn_id AS target_id FROM scored WHERE ai_fraud_class = 'Suspicious')", "feat")),
    "similar_lateral": (["vlen", "pool"], f"""
      SELECT n.target_id, n.txn_id, n.similarity, f.txn_text, f.amount, f.category, f.is_fraud_label
      FROM ({_near("(SELECT txn_id AS target_id FROM scored WHERE ai_fraud_class = 'Suspicious')", "pool")}) n JOIN feat f USING (txn_id)"""),
    "stream_late_days": (["txn"], "SELECT txn_ts::DATE AS spend_date, count(*) AS txn_count, round(sum(amount), 2) AS total_spend, round(avg(amount), 8) AS avg_ticket FROM txn GROUP BY 1"),
    "stream_newest": (["bars"], "SELECT ticker, ts, CASE WHEN day(ts) % 2 = 0 THEN round(close + 0.5, 4) ELSE close END AS close FROM bars"),
    "stream_account_means": (["txn"], """
      SELECT account_id, category, count(*) AS rows, round(sum(sum(a)) OVER (PARTITION BY account_id)::DOUBLE / sum(count(a)) OVER (PARTITION BY account_id), 8) AS acct_avg_amount,
             round(sum(a)::DOUBLE / count(a), 8) AS cat_avg
      FROM (SELECT account_id, category, amount::DECIMAL(28, 2) AS a FROM txn WHERE txn_ts >= TIMESTAMP '2024-01-04') GROUP BY account_id, category"""),
    "similar_tvf": (["vlen", "pool"], f"""
      SELECT n.txn_id, n.similarity, f.txn_text, f.amount, f.category, f.is_fraud_label
      FROM ({_near("(SELECT txn_id AS target_id FROM scored WHERE ai_fraud_class = 'Suspicious' ORDER BY txn_ts DESC, txn_id LIMIT 1)", "pool")}) n JOIN feat f USING (txn_id)"""),
    "cosine_to_exemplar": ([], """
      SELECT e.vec_id, e.label, round(list_cosine_similarity(e.embedding::DOUBLE[], x.embedding::DOUBLE[]), 6) AS similarity
      FROM embeddings e JOIN embeddings x ON x.label = e.label AND x.vec_id = (SELECT min(vec_id) FROM embeddings y WHERE y.label = e.label)"""),
    "series_split": (["spend_y", "vol_y", "price_y"], f"""
      SELECT kind, side, series, count(*) AS n, min(ts) AS first_ts, round(sum(y), 2) AS total
      FROM (SELECT 'spend' AS kind, CASE WHEN ts < {LONG} - 30 THEN 'train' ELSE 'eval' END AS side, * FROM spend_y
            UNION ALL SELECT 'volume', CASE WHEN ts < {JOBS} - 30 THEN 'train' ELSE 'eval' END, * FROM vol_y
            UNION ALL SELECT 'price', CASE WHEN ts < {JOBS} - 30 THEN 'train' ELSE 'eval' END, * FROM price_y)
      GROUP BY kind, side, series"""),
    "table_sinks": (["txn"], """
      SELECT 'appended' AS name, count(*) AS n, round(sum(amount), 2) AS amount FROM (SELECT amount FROM txn UNION ALL SELECT amount FROM txn WHERE amount > 1000)
      UNION ALL SELECT 'reloaded', count(*), round(sum(amount), 2) FROM txn WHERE amount <= 1000
      UNION ALL SELECT 'made', count(*), round(sum(amount), 2) FROM (SELECT * FROM txn UNION ALL SELECT * FROM txn WHERE amount > 1000) WHERE category = 'view'"""),
    "serving_views": (["jlatest", "jkpis", "jexplained", "js_out", "jv_out", "jf_out", "jp_out", "enriched", "moodday", "themes"], " UNION ALL ".join(
        f"SELECT '{view}' AS t, count(*) AS n_rows, round(coalesce(sum(({number})::DOUBLE), 0), 2) AS total, "
        f"coalesce(sum(length({text})), 0)::BIGINT AS letters FROM {source}"
        for view, number, text, source in [
            ("v_market_latest", "close + prev_close + volume", "ticker", "jlatest"),
            ("v_market_intraday", "open + high + low + close + volume", "ticker", "jbars"),
            ("v_spend_kpis", "spend_30d + txns_30d + avg_ticket_30d + spend_mom_pct", "''", "jkpis"),
            ("v_spend_trend", "total_spend + txn_count + avg_ticket", "''", "jspend"),
            ("v_category_share", "s + n", "category", f"(SELECT category, sum(amount) AS s, count(*) AS n FROM txn_s WHERE txn_ts::DATE >= {JOBS} - 30 GROUP BY category)"),
            ("v_spend_series", "y", "series", "jspend_y"), ("v_volume_series", "y", "series", "jvol_y"), ("v_price_series", "y", "series", "jprice_y"),
            ("v_spend_train", "y", "series", "jspend_tr"), ("v_spend_eval", "y", "series", "jspend_ev"),
            ("v_volume_train", "y", "series", "jvol_tr"), ("v_volume_eval", "y", "series", "jvol_ev"),
            ("v_spend_anomalies", "y + forecast + upper_bound", "''", "js_out"),
            ("v_volume_anomalies", "y + forecast", "series", "(SELECT * FROM jv_out WHERE y < lower_bound OR y > upper_bound)"),
            ("v_fraud_flagged", "amount + round(amt_vs_cat_avg, 1) + rule_score", "ai_reason", "jexplained"),
            ("v_spend_forecast", "forecast + upper_bound", "''", "jf_out"), ("v_price_forecast", "forecast + upper_bound", "series", "jp_out"),
            ("v_news_feed", "sentiment_score", "headline || summary || sentiment_label", "enriched"),
            ("v_price_vs_sentiment", "close + coalesce(avg_sentiment, 0)", "o.ticker", "johlc o LEFT JOIN moodday m ON m.ticker = o.ticker AND m.d = o.trade_date"),
            ("v_spend_insight", "0", "''", "(SELECT 1)"), ("v_news_themes", "articles + avg_sentiment", "narrative", "themes"),
        ])),
    "spend_insight": (["cand"], f"""
      SELECT *, '- ' || top_category || ' leads with ' || printf('%.1f', top_share_pct) || '% of spend.' || chr(10) || '- ' || riser_category
             || ' moved most against the week before: ' || printf('%.2f', riser_change) || '.' || chr(10) || '- ' || risky_txns
             || ' transactions match at least two risk patterns.' AS insight
      FROM (SELECT (SELECT category FROM g ORDER BY round(spend, 2) DESC, category DESC LIMIT 1) AS top_category,
                   round((SELECT max(round(spend, 2)) FROM g) / (SELECT sum(spend) FROM g) * 100, 1) AS top_share_pct,
                   (SELECT category FROM g ORDER BY round(spend - before, 2) DESC, category DESC LIMIT 1) AS riser_category,
                   (SELECT max(round(spend - before, 2)) FROM g) AS riser_change,
                   (SELECT sum(risky)::BIGINT FROM g) AS risky_txns)"""),
    "daily_brief": (["moved", "kpis", "explained", "themes"], """
      SELECT *, '## Markets' || chr(10) || 'Top gainers: ' || gainers || chr(10) || 'Top losers: ' || losers || chr(10) || '## Spending' || chr(10)
             || '30-day spend $' || printf('%.0f', spend_30d) || ', ' || printf('%.1f', spend_mom_pct) || '% against the 30 days before' || chr(10)
             || '## Risk' || chr(10) || flagged || ' flagged transactions' || chr(10) || themes AS brief
      FROM (SELECT (SELECT string_agg(ticker || ' ' || printf('%.2f', pct) || '%', ', ' ORDER BY rank) FROM moved WHERE side = 'gainer') AS gainers,
                   (SELECT string_agg(ticker || ' ' || printf('%.2f', pct) || '%', ', ' ORDER BY rank) FROM moved WHERE side = 'loser') AS losers,
                   (SELECT round(spend_30d, 2) FROM kpis) AS spend_30d, (SELECT round(spend_mom_pct, 1) FROM kpis) AS spend_mom_pct,
                   (SELECT count(*) FROM explained) AS flagged,
                   (SELECT string_agg('- ' || ticker || ': ' || narrative, chr(10) ORDER BY ticker) FROM (SELECT * FROM themes ORDER BY ticker LIMIT 5)) AS themes)"""),
    "metric_txn": (["txn"], """
      SELECT date_trunc('week', txn_ts)::DATE AS txn_ts_week, category, channel, round(sum(amount), 2) AS total_spend,
             count(txn_id) AS transaction_count, round(avg(amount), 8) AS avg_ticket
      FROM txn WHERE country <> 'US' GROUP BY ALL"""),
    "metric_market": (["daily"], """
      SELECT date_trunc('month', trade_date)::DATE AS trade_date_month, ticker, round(avg(close), 6) AS close_price,
             round(avg(daily_return), 8) AS avg_daily_return, sum(volume)::BIGINT AS total_volume
      FROM daily GROUP BY ALL"""),
    "metric_news": (["mood"], "SELECT ticker AS news_ticker, sentiment_label, topic, count(news_id) AS article_count, round(avg(sentiment_score), 6) AS avg_sentiment FROM mood GROUP BY ALL"),
    "vq_spend_by_category": (["txn"], "SELECT category, round(sum(amount), 2) AS total_spend FROM txn GROUP BY category"),
    "vq_worst_return": (["daily"], "SELECT ticker, round(avg(daily_return), 8) AS avg_return FROM daily GROUP BY ticker"),
    "vq_negative_news": (["mood"], "SELECT ticker, round(avg(sentiment_score), 6) AS avg_sentiment, count(*) AS articles FROM mood GROUP BY ticker"),
    "stream_ingest": (["txn_s"], "SELECT * FROM txn_s WHERE merchant <> 'Merchant 99' UNION ALL SELECT * FROM txn_s WHERE merchant = 'Merchant 0'"),
    "stream_dedup": (["txn"], "SELECT * FROM txn"),
    "stream_spend_daily": (["txn"], "SELECT txn_ts::DATE AS spend_date, count(*) AS txn_count, round(sum(amount), 2) AS total_spend, round(avg(amount), 8) AS avg_ticket FROM txn GROUP BY 1"),
    "stream_ohlc_daily": ([], """
      SELECT ticker, ts::DATE AS trade_date, arg_min(open, ts) AS open, max(greatest(open, close)) AS high, min(least(open, close)) AS low,
             arg_max(close, ts) AS close, sum(volume)::BIGINT AS volume
      FROM (SELECT event_type AS ticker, ts, value AS open, round(value * (1 + ((event_id % 7) - 3) / 100::DOUBLE), 4) AS close, user_id + 1 AS volume FROM events)
      GROUP BY 1, 2"""),
    "stream_medallion": (["txn"], "SELECT txn_ts::DATE AS spend_date, category, count(*) AS txn_count, round(sum(amount), 2) AS total_spend FROM txn WHERE merchant <> 'Merchant 99' GROUP BY 1, 2"),
    "stream_quarantine": (["txn"], """SELECT '{"txn_id": "' || txn_id || '", "amount": ' AS text FROM txn WHERE merchant = 'Merchant 99'"""),
    "stream_features": (["feat_s"], f"SELECT {_FEAT} FROM feat_s"),
    "stream_news": (["news"], "SELECT * FROM news"),
    "stream_market": (["polled"], """
      SELECT *, round(close / nullif(lag(close) OVER (PARTITION BY ticker ORDER BY trade_date), 0) - 1, 8) AS daily_return
      FROM (SELECT ticker, ts::DATE AS trade_date, arg_min(open, ts) AS open, max(high) AS high, min(low) AS low,
                   arg_max(CASE WHEN day(ts) % 2 = 0 AND event_id % 11 <> 0 THEN round(close + 0.5, 4) ELSE close END, ts) AS close,
                   sum(volume)::BIGINT AS volume
            FROM polled GROUP BY 1, 2)"""),
    "audit_counts": (["ohlc", "spend", "bycat", "feat", "news"], """
      SELECT 'market_daily' AS t, count(*) AS n_rows FROM ohlc UNION ALL SELECT 'spend_daily', count(*) FROM spend
      UNION ALL SELECT 'spend_by_category', count(*) FROM bycat UNION ALL SELECT 'txn_features', count(*) FROM feat
      UNION ALL SELECT 'news', count(*) FROM news"""),
    "scalar_suite": (["ev"], """
      SELECT event_id, hour(ts)::INTEGER AS hour, dayofweek(ts)::INTEGER AS dow, ts::DATE AS day, floor(epoch(ts))::BIGINT AS epoch,
             make_timestamp((floor(epoch(ts))::BIGINT * 1000000)::BIGINT) AS from_epoch, strftime(ts, '%Y-%m-%dT%H:%M:%S') AS iso,
             date_trunc('second', ts) AS parsed, ts - to_minutes(k) AS minutes_back, ts::DATE - k AS days_back,
             round(CASE WHEN k % 5 = 0 THEN 0 ELSE value / (k % 5)::DOUBLE END, 6) AS div0,
             round(value / nullif((k % 5)::DOUBLE, 0), 6) AS ratio,
             CASE WHEN k % 5 > 2 THEN 1 ELSE 0 END::INTEGER AS flag,
             round(exp(0.0::DOUBLE - abs(value) / 100::DOUBLE), 8) AS decay,
             greatest(value, (k % 5)::DOUBLE) AS hi, least(value, (k % 5)::DOUBLE) AS lo,
             event_type || '/' || nullif(k, 7) AS label, printf('%.2f', value) AS money,
             (k + 1)::BIGINT AS second_x, event_id::VARCHAR AS id_text,
             CASE k % 3 WHEN 0 THEN 'online' WHEN 1 THEN 'in_store' ELSE 'other' END AS channel
      FROM ev"""),
}

RELATIONS["g"] = (["cand"], f"""
      SELECT category, coalesce(sum(amount) FILTER (WHERE txn_ts::DATE >= {TXN} - 7), 0) AS spend,
             coalesce(sum(amount) FILTER (WHERE txn_ts::DATE < {TXN} - 7), 0) AS before,
             count(*) FILTER (WHERE txn_ts::DATE >= {TXN} - 7 AND rule_score >= 2) AS risky
      FROM cand WHERE txn_ts::DATE >= {TXN} - 14 GROUP BY category""")
_STATEMENTS["spend_insight"] = (["g"], _STATEMENTS["spend_insight"][1])


def statements() -> dict[str, str]:
    return {name: _with(names, select) for name, (names, select) in _STATEMENTS.items()}
