"""Independent DuckDB statement of every catalogued query.

Each query is written from the operator's definition (not from the Spark
plan) over the driver's raw tables; the adapter is restated as SQL CTEs.
The catalogue's rounding spec is applied to the outer SELECT.
"""
from __future__ import annotations

ACTIVITY = ("['EXTRACAO DE MINERIO - METAIS', 'GERACAO DE ENERGIA; SOLAR', "
            "'COMERCIO DE COMBUSTIVEL/POSTO', 'SIDERURGIA', 'CONSTRUCAO DE OBRAS', "
            "'FABRICACAO EM GERAL', 'PRODUTOS QUIMICOS', 'MEDICAMENTO HUMANO', "
            "'SOFTWARE SOB ENCOMENDA', 'VAREJO DE LOJA', 'CONSULTORIA EMPRESARIAL', "
            "'RESTAURANTE', 'PESCA']")

# Shared CTEs, in dependency order.  DuckDB inlines the ones a query uses.
CTES: list[tuple[str, str]] = [
    ("sup_n", "SELECT count(*) AS n FROM supplier"),
    ("pay", """
        SELECT 'E' || lpad(CAST(o.o_custkey % (SELECT n FROM sup_n) AS VARCHAR), 6, '0') AS ID_PGTO,
               'E' || lpad(CAST(l.l_suppkey AS VARCHAR), 6, '0') AS ID_RCBE,
               o.o_orderdate AS ts,
               l.l_extendedprice * (CAST(1 AS DOUBLE) - l.l_discount)
                 * (CAST(3 + l.l_suppkey % 5 AS DOUBLE) / CAST(5 AS DOUBLE)) AS VL,
               o.o_orderpriority AS prio,
               l.l_orderkey AS okey
        FROM lineitem l JOIN orders o ON l.l_orderkey = o.o_orderkey"""),
    ("base2", """
        SELECT ID_PGTO, ID_RCBE, CAST(date_trunc('month', ts) AS DATE) AS DT_REFE,
               CASE WHEN okey % 997 = 0 THEN 0.0 ELSE VL END AS VL,
               CASE prio WHEN '1-URGENT' THEN 'PIX' WHEN '2-HIGH' THEN 'TED'
                         WHEN '3-MEDIUM' THEN 'BOLETO' ELSE 'OUTROS' END AS DS_TRAN
        FROM pay WHERE ID_PGTO <> ID_RCBE"""),
    ("base2_raw", """
        SELECT ID_PGTO, ID_RCBE, ts AS DT_REFE,
               CASE WHEN okey % 997 = 0 THEN 'n/a' ELSE CAST(VL AS VARCHAR) END AS VL,
               CASE prio WHEN '1-URGENT' THEN ' pix ' WHEN '2-HIGH' THEN 'Ted'
                         WHEN '3-MEDIUM' THEN 'BOLETO' WHEN '4-NOT SPECIFIED' THEN 'SISTEMICO'
                         WHEN '5-LOW' THEN 'cheque' END AS DS_TRAN
        FROM pay"""),
    ("ledger_in", """
        SELECT ID_PGTO, ID_RCBE, CAST(date_trunc('month', DT_REFE) AS DATE) AS DT_REFE,
               coalesce(TRY_CAST(trim(VL) AS DOUBLE), 0.0) AS VL,
               CASE upper(trim(DS_TRAN)) WHEN 'PIX' THEN 'PIX' WHEN 'TED' THEN 'TED'
                    WHEN 'BOLETO' THEN 'BOLETO' ELSE 'OUTROS' END AS DS_TRAN
        FROM base2_raw"""),
    ("months", """
        SELECT CAST(unnest(generate_series(min(date_trunc('month', o_orderdate)),
                                           max(date_trunc('month', o_orderdate)),
                                           INTERVAL 1 MONTH)) AS DATE) AS m
        FROM orders"""),
    ("prof", f"""
        SELECT s_suppkey AS k, 'E' || lpad(CAST(s_suppkey AS VARCHAR), 6, '0') AS ID, months.m AS DT_REFE,
               CAST([100000, 1000000, 10000000, 400000000][(s_suppkey // 2) % 4 + 1] AS DOUBLE)
                 * (CAST(1 AS DOUBLE) + abs(s_acctbal) / CAST(20000 AS DOUBLE)) AS VL_FATU,
               CAST(s_acctbal AS DOUBLE) AS VL_SLDO,
               CASE WHEN s_suppkey % 29 = 28 THEN NULL
                    ELSE DATE '1985-01-01' + CAST((s_suppkey * 197) % 6000 AS INTEGER) END AS DT_ABRT,
               {ACTIVITY}[CASE WHEN s_suppkey % 10 < 6 THEN s_suppkey % 2 ELSE s_suppkey % 13 END + 1] AS DS_CNAE
        FROM supplier, months"""),
    ("base1", "SELECT ID, DT_REFE, VL_FATU, VL_SLDO, DT_ABRT, DS_CNAE FROM prof"),
    ("base1_raw", """
        SELECT ID, CAST(DT_REFE + CAST(k % 28 AS INTEGER) AS TIMESTAMP) AS DT_REFE,
               CAST(VL_FATU AS VARCHAR) AS VL_FATU,
               CASE WHEN k % 17 = 16 THEN 'n/a' ELSE CAST(VL_SLDO AS VARCHAR) END AS VL_SLDO,
               DT_ABRT, DS_CNAE
        FROM prof"""),
    # monthly flows: receiver sums and payer sums, full outer join, 0-filled
    ("rec", "SELECT ID_RCBE AS ID, DT_REFE AS ym, sum(VL) AS r FROM base2 GROUP BY 1, 2"),
    ("des", "SELECT ID_PGTO AS ID, DT_REFE AS ym, sum(VL) AS d FROM base2 GROUP BY 1, 2"),
    ("mf0", """
        SELECT coalesce(rec.ID, des.ID) AS ID, coalesce(rec.ym, des.ym) AS year_month,
               coalesce(r, 0.0) AS receita_mensal, coalesce(d, 0.0) AS despesa_mensal
        FROM rec FULL OUTER JOIN des ON rec.ID = des.ID AND rec.ym = des.ym"""),
    ("flows", """
        SELECT ID, year_month, receita_mensal, despesa_mensal,
               receita_mensal - despesa_mensal AS fluxo_liquido,
               CASE WHEN prev IS NULL THEN NULL
                    WHEN prev <> 0 THEN receita_mensal / prev - 1
                    WHEN receita_mensal > 0 THEN CAST('inf' AS DOUBLE)
                    WHEN receita_mensal < 0 THEN CAST('-inf' AS DOUBLE) END AS g_receita_mom,
               CASE WHEN n3 = 3 THEN sd3 END AS vol_receita_3m
        FROM (SELECT *, lag(receita_mensal) OVER (PARTITION BY ID ORDER BY year_month) AS prev,
                     count(*) OVER (PARTITION BY ID ORDER BY year_month ROWS BETWEEN 2 PRECEDING AND CURRENT ROW) AS n3,
                     stddev_samp(receita_mensal) OVER (PARTITION BY ID ORDER BY year_month
                                                       ROWS BETWEEN 2 PRECEDING AND CURRENT ROW) AS sd3
              FROM mf0) x"""),
    ("fem", """
        SELECT b.ID, b.DT_REFE AS year_month, b.DT_ABRT, b.DS_CNAE,
               coalesce(b.VL_FATU, 0.0) AS VL_FATU, coalesce(b.VL_SLDO, 0.0) AS VL_SLDO,
               coalesce(f.receita_mensal, 0.0) AS receita_mensal,
               coalesce(f.despesa_mensal, 0.0) AS despesa_mensal,
               coalesce(f.fluxo_liquido, 0.0) AS fluxo_liquido,
               coalesce(f.g_receita_mom, 0.0) AS g_receita_mom,
               coalesce(f.vol_receita_3m, 0.0) AS vol_receita_3m
        FROM base1 b LEFT JOIN flows f ON b.ID = f.ID AND b.DT_REFE = f.year_month"""),
    ("rep", """
        SELECT ID, year_month, strftime(year_month, '%Y-%m') AS ym_str,
               CASE WHEN isfinite(receita_mensal) THEN receita_mensal ELSE 0.0 END AS receita_mensal,
               CASE WHEN isfinite(despesa_mensal) THEN despesa_mensal ELSE 0.0 END AS despesa_mensal,
               CASE WHEN isfinite(fluxo_liquido) THEN fluxo_liquido ELSE 0.0 END AS fluxo_liquido,
               CASE WHEN isfinite(g_receita_mom) THEN g_receita_mom ELSE 0.0 END AS g_receita_mom,
               CASE WHEN isfinite(vol_receita_3m) THEN vol_receita_3m ELSE 0.0 END AS vol_receita_3m
        FROM fem WHERE year_month IS NOT NULL"""),
    ("edges", """
        SELECT ID_PGTO AS src, ID_RCBE AS dst, DT_REFE AS year_month, DS_TRAN AS channel,
               sum(VL) AS valor, count(*) AS n
        FROM base2 GROUP BY 1, 2, 3, 4"""),
]

BODIES: dict[str, str] = {}


def _reg(name: str, sql: str, ctes: list[tuple[str, str]] | None = None):
    BODIES[name] = (sql, ctes or [])


_reg("ingest_profile", """
    SELECT ID, CAST(date_trunc('month', DT_REFE) AS DATE) AS DT_REFE,
           TRY_CAST(trim(VL_FATU) AS DOUBLE) AS VL_FATU, TRY_CAST(trim(VL_SLDO) AS DOUBLE) AS VL_SLDO,
           DT_ABRT, DS_CNAE FROM base1_raw""")
_reg("ingest_transactions", "SELECT * FROM ledger_in")
_reg("ingest_counts", """
    SELECT 'base1' AS "table", count(*) AS n_rows FROM base1_raw
    UNION ALL SELECT 'base2', count(*) FROM base2_raw""")
_reg("ingest_rejects", """
    SELECT 'base1' AS "table", CASE WHEN TRY_CAST(trim(VL_SLDO) AS DOUBLE) IS NULL AND VL_SLDO IS NOT NULL THEN 'VL_SLDO' ELSE '' END AS reason,
           count(*) AS n_rows FROM base1_raw GROUP BY 2
    UNION ALL
    SELECT 'base2', CASE WHEN TRY_CAST(trim(VL) AS DOUBLE) IS NULL AND VL IS NOT NULL THEN 'VL' ELSE '' END, count(*)
    FROM base2_raw GROUP BY 2""")
_reg("sql_over_parquet", """
    SELECT 'E' || lpad(CAST(l_suppkey AS VARCHAR), 6, '0') AS ID, s_nationkey AS nation,
           count(*) AS n_lines, sum(l_extendedprice) AS gross_value
    FROM lineitem JOIN supplier ON l_suppkey = s_suppkey GROUP BY l_suppkey, s_nationkey""")
_reg("load_edges_for_network", "SELECT ID_PGTO, ID_RCBE, DT_REFE AS year_month, VL, DS_TRAN FROM base2")
_reg("edges_month", "SELECT * FROM edges")
_reg("company_ids", """
    SELECT DISTINCT ID FROM fem WHERE ID IS NOT NULL ORDER BY ID""")
_reg("month_list", """
    SELECT year_month, strftime(year_month, '%Y-%m') AS ym_str
    FROM (SELECT DISTINCT DT_REFE AS year_month FROM base2 WHERE DT_REFE IS NOT NULL) d""")
_reg("validate", """
    SELECT "check", CAST(n_bad AS BIGINT) AS n_bad, n_bad > 0 AS failed FROM (
      SELECT 'duplicate_profile_key' AS "check",
             (SELECT coalesce(sum(c - 1), 0) FROM (SELECT count(*) AS c FROM base1 GROUP BY ID, DT_REFE) WHERE c > 1) AS n_bad
      UNION ALL SELECT 'non_positive_amount', (SELECT count(*) FROM ledger_in WHERE VL <= 0)
      UNION ALL SELECT 'self_payment', (SELECT count(*) FROM ledger_in WHERE ID_PGTO = ID_RCBE)
      UNION ALL SELECT 'channel_out_of_domain',
             (SELECT count(*) FROM ledger_in WHERE NOT coalesce(DS_TRAN IN ('PIX', 'TED', 'BOLETO', 'OUTROS'), false))
      UNION ALL SELECT 'month_before_floor', (SELECT count(*) FROM ledger_in WHERE DT_REFE < DATE '2025-03-01')
      UNION ALL SELECT 'month_after_profile',
             (SELECT count(*) FROM ledger_in WHERE DT_REFE > (SELECT max(DT_REFE) FROM base1))) t""")
_reg("monthly_flows", "SELECT * FROM flows")
_reg("f_empresa_mes", "SELECT * FROM fem")
_reg("load_flows_for_reporting", "SELECT * FROM rep")
_reg("monthly_agg", """
    SELECT ID, year_month, ym_str, sum(receita_mensal) AS receita_mensal, sum(despesa_mensal) AS despesa_mensal,
           sum(fluxo_liquido) AS fluxo_liquido, avg(g_receita_mom) AS g_receita_mom,
           avg(vol_receita_3m) AS vol_receita_3m
    FROM rep GROUP BY 1, 2, 3""")
_reg("period_options", """
    SELECT ID, year_month, strftime(year_month, '%Y-%m') AS ym_str,
           row_number() OVER (PARTITION BY ID ORDER BY year_month DESC) <= 6 AS is_default
    FROM (SELECT DISTINCT ID, year_month FROM fem WHERE year_month IS NOT NULL) d""")


# ------------------------------------------------------------ relations
CTES += [
    ("lastm", "SELECT max(DT_REFE) AS m FROM base2"),
    ("rleg", """
        SELECT ID_RCBE AS company_id, ID_PGTO AS counterparty, 'in' AS direction, DT_REFE, VL FROM base2
        WHERE DT_REFE >= (SELECT m FROM lastm) - INTERVAL 11 MONTH AND DT_REFE <= (SELECT m FROM lastm)
        UNION ALL
        SELECT ID_PGTO, ID_RCBE, 'out', DT_REFE, VL FROM base2
        WHERE DT_REFE >= (SELECT m FROM lastm) - INTERVAL 11 MONTH AND DT_REFE <= (SELECT m FROM lastm)"""),
    ("rimp", """
        SELECT p.counterparty, p.valor, p.meses, p.valor / c.tot AS share,
               p.meses / greatest(1, c.nm) AS freq_mensal,
               0.6 * (p.valor / c.tot) + 0.4 * (p.meses / greatest(1, c.nm)) AS score,
               p.company_id, p.direction
        FROM (SELECT company_id, direction, counterparty, sum(VL) AS valor, count(DISTINCT DT_REFE) AS meses
              FROM rleg GROUP BY 1, 2, 3) p
        JOIN (SELECT company_id, direction, sum(VL) AS tot, count(DISTINCT DT_REFE) AS nm
              FROM rleg GROUP BY 1, 2) c
          ON p.company_id = c.company_id AND p.direction = c.direction"""),
    # ego networks: last 3 months, both directions, all channels, top 25 per ego
    ("ewin", """
        SELECT ID_PGTO AS src, ID_RCBE AS dst, sum(VL) AS weight FROM base2
        WHERE DT_REFE >= (SELECT m FROM lastm) - INTERVAL 2 MONTH AND DT_REFE <= (SELECT m FROM lastm)
        GROUP BY 1, 2"""),
    ("egoe", """
        SELECT ego, src, dst, weight, edge_rank FROM (
          SELECT ego, src, dst, weight,
                 row_number() OVER (PARTITION BY ego ORDER BY weight DESC, src, dst) AS edge_rank
          FROM (SELECT dst AS ego, src, dst, weight FROM ewin
                UNION ALL SELECT src AS ego, src, dst, weight FROM ewin WHERE src <> dst) u) r
        WHERE edge_rank <= 25"""),
    ("enodes0", """
        SELECT ego, node_id, sum(in_w) AS in_w, sum(out_w) AS out_w,
               max(pays) AS p, max(paid) AS r
        FROM (SELECT ego, src AS node_id, 0.0 AS in_w, weight AS out_w,
                     CASE WHEN dst = ego THEN 1 ELSE 0 END AS pays, 0 AS paid FROM egoe
              UNION ALL
              SELECT ego, dst, weight, 0.0, 0, CASE WHEN src = ego THEN 1 ELSE 0 END FROM egoe) x
        GROUP BY 1, 2"""),
    ("enodes", """
        SELECT n.ego, n.node_id,
               CASE WHEN n.node_id = n.ego THEN 'ego' WHEN n.p = 1 THEN 'payer_to_ego'
                    WHEN n.r = 1 THEN 'receiver_from_ego' ELSE 'neighbor' END AS role,
               n.in_w, n.out_w, n.in_w + n.out_w AS strength,
               1.0 / g.nn AS pagerank,
               CASE WHEN n.node_id = n.ego AND g.nn > 2
                    THEN CAST(g.np * g.nr - g.nb AS DOUBLE) / CAST((g.nn - 1) * (g.nn - 2) AS DOUBLE)
                    ELSE 0.0 END AS betweenness
        FROM enodes0 n JOIN (
          SELECT ego, count(*) AS nn,
                 sum(CASE WHEN node_id <> ego THEN p ELSE 0 END) AS np,
                 sum(CASE WHEN node_id <> ego THEN r ELSE 0 END) AS nr,
                 sum(CASE WHEN node_id <> ego THEN p * r ELSE 0 END) AS nb
          FROM enodes0 GROUP BY ego) g ON n.ego = g.ego"""),
    ("companies", "SELECT DISTINCT ID FROM base1"),
]

_reg("relation_importance", "SELECT * FROM rimp")
_reg("top_relations", """
    SELECT * FROM (
      SELECT *, row_number() OVER (PARTITION BY company_id, direction ORDER BY score DESC, counterparty) AS rank
      FROM rimp) t
    WHERE rank <= 10 AND company_id IN (SELECT ID FROM companies)""")
_reg("concentration_hhi", """
    SELECT company_id,
           sum(CASE WHEN direction = 'in' THEN share * share END) AS hhi_in,
           sum(CASE WHEN direction = 'out' THEN share * share END) AS hhi_out
    FROM rimp GROUP BY company_id""")
_reg("ego_edges_by_month", """
    SELECT ego, src, dst, valor, edge_rank FROM (
      SELECT ego, src, dst, valor, row_number() OVER (PARTITION BY ego ORDER BY valor DESC, src, dst) AS edge_rank
      FROM (SELECT dst AS ego, src, dst, valor FROM m1 UNION ALL SELECT src, src, dst, valor FROM m1) u) r
    WHERE edge_rank <= 15""",
     [("m1", "SELECT ID_PGTO AS src, ID_RCBE AS dst, sum(VL) AS valor FROM base2 "
             "WHERE DT_REFE = (SELECT m FROM lastm) GROUP BY 1, 2")])
_reg("ego_network", "SELECT * FROM egoe")
_reg("ego_network_pix_ted", """
    SELECT ego, src, dst, weight, edge_rank FROM (
      SELECT src AS ego, src, dst, weight,
             row_number() OVER (PARTITION BY src ORDER BY weight DESC, src, dst) AS edge_rank
      FROM (SELECT ID_PGTO AS src, ID_RCBE AS dst, sum(VL) AS weight FROM base2
            WHERE DT_REFE >= (SELECT m FROM lastm) - INTERVAL 2 MONTH AND DT_REFE <= (SELECT m FROM lastm)
              AND DS_TRAN IN ('PIX', 'TED')
            GROUP BY 1, 2) w) r
    WHERE edge_rank <= 25""")
_reg("ego_nodes", "SELECT * FROM enodes")
_reg("ego_summary", """
    SELECT c.ID AS ego, CAST(coalesce(nn, 0) AS BIGINT) AS n_nodes, CAST(coalesce(ne, 0) AS BIGINT) AS n_edges,
           CAST(coalesce(ne, 0) AS DOUBLE) / CAST(CASE WHEN coalesce(nn, 0) > 1 THEN nn * (nn - 1) ELSE 1 END AS DOUBLE)
             AS density
    FROM companies c
    LEFT JOIN (SELECT ego, count(DISTINCT node) AS nn FROM
                 (SELECT ego, src AS node FROM egoe UNION ALL SELECT ego, dst FROM egoe) x GROUP BY ego) a
      ON a.ego = c.ID
    LEFT JOIN (SELECT ego, count(*) AS ne FROM egoe GROUP BY ego) b ON b.ego = c.ID""")
_reg("network_scaled", """
    SELECT ego, 'node' AS element, node_id, CAST(NULL AS VARCHAR) AS src, CAST(NULL AS VARCHAR) AS dst,
           strength AS value,
           CASE WHEN max(strength) OVER (PARTITION BY ego) <= min(strength) OVER (PARTITION BY ego) THEN 55.0
                ELSE 30.0 + (strength - min(strength) OVER (PARTITION BY ego))
                     / (max(strength) OVER (PARTITION BY ego) - min(strength) OVER (PARTITION BY ego)) * 50.0 END
             AS scaled,
           role AS kind, false AS most_important
    FROM enodes
    UNION ALL
    SELECT ego, 'edge', NULL, src, dst, weight,
           CASE WHEN max(weight) OVER (PARTITION BY ego) <= min(weight) OVER (PARTITION BY ego) THEN 4.0
                ELSE 2.0 + (weight - min(weight) OVER (PARTITION BY ego))
                     / (max(weight) OVER (PARTITION BY ego) - min(weight) OVER (PARTITION BY ego)) * 6.0 END,
           CASE WHEN src = ego THEN 'out' ELSE 'in' END,
           edge_rank = 1
    FROM egoe""")
_reg("critical_relationship", """
    SELECT ego, CASE WHEN src = ego THEN 'pays' ELSE 'receives' END AS direction,
           CASE WHEN src = ego THEN dst ELSE src END AS partner, weight AS valor
    FROM egoe WHERE edge_rank = 1""")
_reg("relationships_table", """
    SELECT e.ego, e.edge_rank AS position, CASE WHEN src = e.ego THEN 'out' ELSE 'in' END AS direction,
           CASE WHEN src = e.ego THEN dst ELSE src END AS partner, weight, weight > q.p80 AS high_risk
    FROM egoe e JOIN (SELECT ego, quantile_cont(weight, 0.8) AS p80 FROM egoe GROUP BY ego) q ON e.ego = q.ego
    WHERE e.edge_rank <= 15""")
_reg("network_resilience", """
    SELECT c.ID AS ego,
           coalesce(0.3 * conn + 0.3 * red + 0.2 * (1.0 - cent) + 0.2 * 0.0, 0.0)::DOUBLE AS resilience_score,
           coalesce(red, 0.0)::DOUBLE AS redundancy, coalesce(conn, 0.0)::DOUBLE AS connectivity, 0.0::DOUBLE AS clustering,
           coalesce(cent, 0.0)::DOUBLE AS degree_centrality
    FROM companies c LEFT JOIN (
      SELECT ego,
             CASE WHEN n >= 2 THEN 1.0 ELSE 0.0 END AS conn,
             CASE WHEN n > 1 THEN least(1.0, CAST(r AS DOUBLE) / CAST(n - 1 AS DOUBLE)) ELSE 0.0 END AS red,
             CASE WHEN n > 1 THEN CAST(p + r AS DOUBLE) / CAST(n - 1 AS DOUBLE) ELSE 1.0 END AS cent
      FROM (SELECT ego, (SELECT count(DISTINCT z) FROM (SELECT unnest([i.src, i.dst]) AS z FROM egoe i WHERE i.ego = o.ego)) AS n,
                   count(DISTINCT CASE WHEN src = ego AND dst <> ego THEN dst END) AS r,
                   count(DISTINCT CASE WHEN dst = ego AND src <> ego THEN src END) AS p
            FROM egoe o GROUP BY ego) g) x ON x.ego = c.ID""")

_EARLIER = [("lastm", "SELECT DATE '2000-06-01' AS m")]
_reg("relation_importance_at", "SELECT * FROM rimp", _EARLIER)
_reg("ego_network_at", "SELECT * FROM egoe", _EARLIER)
_reg("network_resilience_graph", """
    SELECT v.z AS node, 0.3 * k.conn + 0.3 * red + 0.2 * (1.0 - cent) + 0.2 * clus AS resilience_score, red AS redundancy,
           k.conn AS connectivity, clus AS clustering, cent AS degree_centrality
    FROM (SELECT z, least(1.0, CAST(o + coalesce(two, 0) AS DOUBLE) / (n - 1)) AS red, CAST(o + i AS DOUBLE) / (n - 1) AS cent,
                 CASE WHEN d > 1 THEN coalesce(t, 0) / CAST(d * (d - 1) AS DOUBLE) ELSE 0.0 END AS clus
          FROM (SELECT u.a AS z, count(*) AS d, (SELECT count(*) FROM one WHERE s = u.a) AS o, (SELECT count(*) FROM one WHERE r = u.a) AS i,
                       (SELECT count(DISTINCT a) FROM und) AS n
                FROM und u GROUP BY u.a) g
          LEFT JOIN (SELECT x.s, count(*) AS two FROM one x JOIN one y ON x.r = y.s WHERE y.r <> x.s GROUP BY 1) w ON w.s = g.z
          LEFT JOIN (SELECT x.a, count(*) AS t FROM und x JOIN und y ON x.b = y.a JOIN und c ON c.a = x.a AND c.b = y.b GROUP BY 1) tri
            ON tri.a = g.z) v,
         (WITH RECURSIVE reach AS (SELECT min(a) AS z FROM und UNION SELECT und.b FROM reach JOIN und ON und.a = reach.z)
          SELECT CASE WHEN count(*) = (SELECT count(DISTINCT a) FROM und) THEN 1.0 ELSE 0.0 END::DOUBLE AS conn FROM reach) k""",
     [("one", "SELECT DISTINCT ID_PGTO AS s, ID_RCBE AS r FROM base2 WHERE ID_PGTO <> ID_RCBE "
              "AND DT_REFE >= (SELECT m FROM lastm) - INTERVAL 2 MONTH AND DT_REFE <= (SELECT m FROM lastm)"),
      ("und", "SELECT s AS a, r AS b FROM one UNION SELECT r, s FROM one")])

# ------------------------------------------------------------ risk
CTES += [
    ("pairs", "SELECT ID_PGTO AS src, ID_RCBE AS dst, sum(VL) AS v, count(*) AS n FROM base2 GROUP BY 1, 2"),
    ("pf", """
        SELECT company_id, partner_id, sum(vin) AS vin, sum(vout) AS vout, sum(nin) AS nin, sum(nout) AS nout FROM (
          SELECT dst AS company_id, src AS partner_id, v AS vin, 0.0 AS vout, n AS nin, 0 AS nout FROM pairs
          UNION ALL SELECT src, dst, 0.0, v, 0, n FROM pairs) x GROUP BY 1, 2"""),
    ("cleg", """
        SELECT ID_RCBE AS company_id, ID_PGTO AS partner_id, 'in' AS direction, sum(VL) AS v FROM base2 GROUP BY 1, 2
        UNION ALL SELECT ID_PGTO, ID_RCBE, 'out', sum(VL) FROM base2 GROUP BY 1, 2
        UNION ALL SELECT company_id, partner_id, 'both', vin + vout FROM pf"""),
    ("cmet", """
        SELECT g.company_id, g.direction,
               CASE WHEN t.tot <> 0 THEN t.sq / (t.tot * t.tot) ELSE 0.0 END AS hhi,
               CASE WHEN t.tot <> 0 THEN t.top / t.tot ELSE 0.0 END AS top_partner_share,
               CASE WHEN t.tot <> 0 THEN t.top3 / t.tot ELSE 0.0 END AS top_3_share,
               CAST(CASE WHEN t.tot <> 0 THEN t.np ELSE 0 END AS BIGINT) AS num_partners,
               CASE WHEN t.tot <> 0 THEN t.tot ELSE 0.0 END AS total_volume,
               CASE WHEN t.tot IS NULL OR t.tot = 0 THEN 'BAIXO'
                    WHEN t.top / t.tot > 0.5 THEN 'CRÍTICO'
                    WHEN t.top3 / t.tot > 0.8 THEN 'ALTO'
                    WHEN t.top3 / t.tot > 0.6 THEN 'MÉDIO' ELSE 'BAIXO' END AS concentration_risk
        FROM (SELECT ID AS company_id, d AS direction FROM companies, (VALUES ('in'), ('out'), ('both')) v(d)) g
        LEFT JOIN (
          SELECT company_id, direction, sum(v) AS tot, sum(v * v) AS sq, max(v) AS top, count(*) AS np,
                 sum(CASE WHEN rk <= 3 THEN v END) AS top3
          FROM (SELECT *, row_number() OVER (PARTITION BY company_id, direction ORDER BY v DESC, partner_id) AS rk
                FROM cleg) r
          GROUP BY 1, 2) t ON g.company_id = t.company_id AND g.direction = t.direction"""),
    ("imp", """
        SELECT pf.company_id, partner_id,
               CASE WHEN tin > 0 THEN vin / tin ELSE 0.0 END AS impact_receita_pct,
               CASE WHEN tout > 0 THEN vout / tout ELSE 0.0 END AS impact_pagamentos_pct,
               greatest(CASE WHEN tin > 0 THEN vin / tin ELSE 0.0 END,
                        CASE WHEN tout > 0 THEN vout / tout ELSE 0.0 END) AS impact_total_pct,
               vin AS volume_at_risk_in, vout AS volume_at_risk_out
        FROM pf JOIN (SELECT company_id, sum(vin) AS tin, sum(vout) AS tout FROM pf GROUP BY 1) t
          ON pf.company_id = t.company_id"""),
    ("payers3", """
        SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY company_id
                                                    ORDER BY volume_at_risk_in DESC, partner_id) AS rk
                       FROM imp WHERE volume_at_risk_in > 0) x WHERE rk <= 3"""),
    ("payees3", """
        SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY company_id
                                                    ORDER BY volume_at_risk_out DESC, partner_id) AS rk
                       FROM imp WHERE volume_at_risk_out > 0) x WHERE rk <= 3"""),
    ("scen", """
        SELECT company_id, 'top_payer_loss' AS scenario, partner_id AS affected_companies,
               impact_receita_pct * 100 AS impact_percentage,
               CASE WHEN impact_receita_pct > 0.5 THEN 'CRÍTICO' WHEN impact_receita_pct > 0.3 THEN 'ALTO'
                    WHEN impact_receita_pct > 0.15 THEN 'MÉDIO' ELSE 'BAIXO' END AS risk_level
        FROM payers3 WHERE rk = 1
        UNION ALL
        SELECT company_id, 'top_payee_loss', partner_id, impact_pagamentos_pct * 100,
               CASE WHEN impact_pagamentos_pct > 0.5 THEN 'CRÍTICO' WHEN impact_pagamentos_pct > 0.3 THEN 'ALTO'
                    WHEN impact_pagamentos_pct > 0.15 THEN 'MÉDIO' ELSE 'BAIXO' END
        FROM payees3 WHERE rk = 1
        UNION ALL
        SELECT company_id, 'top_partners_joint_loss', string_agg(partner_id, ',' ORDER BY rk2),
               least(100.0, sum(impact_total_pct) * 100),
               CASE WHEN sum(impact_total_pct) > 0.5 THEN 'CRÍTICO' WHEN sum(impact_total_pct) > 0.3 THEN 'ALTO'
                    WHEN sum(impact_total_pct) > 0.15 THEN 'MÉDIO' ELSE 'BAIXO' END
        FROM (SELECT *, row_number() OVER (PARTITION BY company_id ORDER BY impact_total_pct DESC, partner_id) AS rk2,
                     count(*) OVER (PARTITION BY company_id) AS nu
              FROM (SELECT DISTINCT company_id, partner_id, impact_total_pct FROM payers3
                    UNION SELECT company_id, partner_id, impact_total_pct FROM payees3) u) z
        WHERE nu >= 2 AND rk2 <= 3
        GROUP BY company_id"""),
    ("touch", """
        SELECT ID_PGTO AS node, ID_PGTO, ID_RCBE, DT_REFE, VL FROM base2
        UNION ALL SELECT ID_RCBE, ID_PGTO, ID_RCBE, DT_REFE, VL FROM base2 WHERE ID_RCBE <> ID_PGTO"""),
    ("nprof", """
        SELECT s.node AS partner_id, s.n_payments, s.total / s.n_payments AS avg_transaction_volume,
               c.np AS diversification_level,
               CASE WHEN s.n_payments < 2 THEN 0.8
                    ELSE least(1.0, coalesce(least(0.5, m.sd / (m.mu + 1e-6) / 10), 0.5)
                                    + 0.3 * CASE WHEN c.tot <> 0 THEN c.top / c.tot ELSE 0.0 END
                                    + 0.2 / CAST(greatest(1, CASE WHEN c.tot <> 0 THEN c.np ELSE 0 END) AS DOUBLE))
               END AS risk_score,
               CASE WHEN s.total / s.n_payments > 50000 AND c.np > 10 THEN 'high_volume_well_diversified'
                    WHEN s.total / s.n_payments > 100000 THEN 'high_volume_potential'
                    WHEN c.np > 15 THEN 'well_connected' ELSE 'diversification_opportunity' END
                 AS recommendation_reason
        FROM (SELECT node, count(*) AS n_payments, sum(VL) AS total FROM touch GROUP BY node) s
        JOIN (SELECT node, stddev_samp(mv) AS sd, avg(mv) AS mu
              FROM (SELECT node, DT_REFE, sum(VL) AS mv FROM touch GROUP BY 1, 2) mm GROUP BY node) m
          ON m.node = s.node
        JOIN (SELECT company_id, count(*) AS np, max(vin + vout) AS top, sum(vin + vout) AS tot
              FROM pf GROUP BY company_id) c ON c.company_id = s.node"""),
    ("adj", """
        SELECT DISTINCT a, b FROM (SELECT ID_PGTO AS a, ID_RCBE AS b FROM base2
                                   UNION ALL SELECT ID_RCBE, ID_PGTO FROM base2) x WHERE a <> b"""),
]

_reg("concentration_metrics", "SELECT * FROM cmet")
_reg("counterparty_loss_impact", """
    SELECT company_id, partner_id, impact_receita_pct, impact_pagamentos_pct, impact_total_pct,
           CASE WHEN impact_total_pct > 0.5 THEN 'CATASTRÓFICO' WHEN impact_total_pct > 0.3 THEN 'SEVERO'
                WHEN impact_total_pct > 0.15 THEN 'MODERADO' ELSE 'LEVE' END AS severity,
           CASE WHEN impact_total_pct > 0.5 THEN '12+ meses' WHEN impact_total_pct > 0.3 THEN '6-12 meses'
                WHEN impact_total_pct > 0.15 THEN '3-6 meses' ELSE '1-3 meses' END AS recovery_time_estimate,
           volume_at_risk_in, volume_at_risk_out
    FROM imp""")
_reg("risk_scenarios", """
    SELECT scen.*,
           CASE scenario WHEN 'top_payer_loss' THEN 'loss_cuts_receipts' WHEN 'top_payee_loss' THEN 'loss_cuts_payments'
                ELSE 'joint_loss_cuts_both' END AS description,
           CASE scenario WHEN 'top_payer_loss' THEN 'diversify_payers,alternative_contracts,strategic_safety_stock'
                WHEN 'top_payee_loss' THEN 'diversify_payees,new_sales_channels,retain_existing_clients'
                ELSE 'geographic_and_sector_spread,long_term_contracts,emergency_reserves,contingency_plan' END
             AS mitigation_strategies
    FROM scen""")
_reg("partner_risk_score", "SELECT * FROM nprof")
_DIVERSIFICATION = """
    SELECT company_id, CAST(rank AS BIGINT) AS rank, partner_id, avg_transaction_volume, diversification_level,
           risk_score, recommendation_reason
    FROM (SELECT c AS company_id, q AS partner_id, n.*,
                 row_number() OVER (PARTITION BY c ORDER BY n.risk_score, n.avg_transaction_volume DESC, q) AS rank
          FROM (SELECT DISTINCT m.a AS c, x.b AS q FROM adj m JOIN adj x ON x.a = m.b
                WHERE x.b <> m.a AND NOT EXISTS (SELECT 1 FROM adj y WHERE y.a = m.a AND y.b = x.b)) cq
          JOIN nprof n ON n.partner_id = cq.q) r
    WHERE rank <= 5"""
_reg("diversification_targets", _DIVERSIFICATION)
_reg("diversification_targets_recent", _DIVERSIFICATION, [("base2", dict(CTES)["base2"]
     + " AND date_trunc('month', ts) >= (SELECT max(date_trunc('month', ts)) FROM pay WHERE ID_PGTO <> ID_RCBE) - INTERVAL 1 MONTH")])
_reg("risk_report", """
    SELECT c.ID AS company_id, 6 AS period_months, i.hhi AS hhi_in, o.hhi AS hhi_out,
           i.concentration_risk AS risk_in, o.concentration_risk AS risk_out,
           CAST(coalesce(s.nh, 0) AS BIGINT) AS n_high_scenarios,
           CAST(coalesce(p.np, 0) AS BIGINT) AS current_partners_count,
           least(100.0, i.hhi * 30 + o.hhi * 30 + coalesce(s.nh, 0) * 10
                        + 30.0 / CAST(greatest(1, coalesce(p.np, 0)) AS DOUBLE)) AS overall_risk_score,
           CASE WHEN i.hhi * 30 + o.hhi * 30 + coalesce(s.nh, 0) * 10
                     + 30.0 / CAST(greatest(1, coalesce(p.np, 0)) AS DOUBLE) > 70 THEN 'CRÍTICO'
                WHEN i.hhi * 30 + o.hhi * 30 + coalesce(s.nh, 0) * 10
                     + 30.0 / CAST(greatest(1, coalesce(p.np, 0)) AS DOUBLE) > 50 THEN 'ALTO'
                WHEN i.hhi * 30 + o.hhi * 30 + coalesce(s.nh, 0) * 10
                     + 30.0 / CAST(greatest(1, coalesce(p.np, 0)) AS DOUBLE) > 30 THEN 'MÉDIO'
                ELSE 'BAIXO' END AS risk_classification
    FROM companies c
    JOIN cmet i ON i.company_id = c.ID AND i.direction = 'in'
    JOIN cmet o ON o.company_id = c.ID AND o.direction = 'out'
    LEFT JOIN (SELECT company_id, count(*) AS nh FROM scen WHERE risk_level IN ('ALTO', 'CRÍTICO')
               GROUP BY 1) s ON s.company_id = c.ID
    LEFT JOIN (SELECT company_id, count(*) AS np FROM pf GROUP BY 1) p ON p.company_id = c.ID""")


# ------------------------------------------------------------ staging features
SECTOR_CASE = """CASE
      WHEN t LIKE '%MINERIO%' OR t LIKE '%MINERA%' OR t LIKE '%EXTRAÇÃO%' OR t LIKE '%EXTRACAO%' THEN 'MINERACAO'
      WHEN t LIKE '%ENERGIA%' OR t LIKE '%ELETRICA%' OR t LIKE '%GERAÇÃO%' OR t LIKE '%GERACAO%' THEN 'ENERGIA'
      WHEN t LIKE '%PETROLEO%' OR t LIKE '%GAS%' OR t LIKE '%COMBUSTIVEL%' THEN 'PETROLEO'
      WHEN t LIKE '%SIDERUR%' OR t LIKE '%METALUR%' OR t LIKE '%AÇO%' OR t LIKE '%ACO%' OR t LIKE '%FERRO%' THEN 'SIDERURGIA'
      WHEN t LIKE '%CONSTRUÇÃO%' OR t LIKE '%CONSTRUCAO%' OR t LIKE '%OBRAS%' THEN 'CONSTRUCAO'
      WHEN t LIKE '%MANUFATURA%' OR t LIKE '%FABRICA%' OR t LIKE '%INDUSTRI%' THEN 'MANUFATURA'
      WHEN t LIKE '%QUIMIC%' THEN 'QUIMICA'
      WHEN t LIKE '%FARMACEUTICA%' OR t LIKE '%MEDICAMENTO%' OR t LIKE '%FARMACIA%' THEN 'FARMACEUTICA'
      WHEN t LIKE '%TECNOLOGIA%' OR t LIKE '%SOFTWARE%' OR t LIKE '%TI%' OR t LIKE '%DIGITAL%' THEN 'TECNOLOGIA'
      WHEN t LIKE '%VAREJO%' OR t LIKE '%COMERCIO%' OR t LIKE '%LOJA%' OR t LIKE '%VENDA%' THEN 'VAREJO'
      WHEN t LIKE '%SERVICO%' OR t LIKE '%CONSULTORIA%' OR t LIKE '%ASSESSORIA%' THEN 'SERVICOS'
      WHEN t LIKE '%ALIMENTO%' OR t LIKE '%ALIMENTAR%' OR t LIKE '%RESTAURANTE%' OR t LIKE '%COMIDA%' THEN 'ALIMENTACAO'
      ELSE 'OUTROS' END"""


def sector_sql(col: str) -> str:
    return SECTOR_CASE.replace("t LIKE", f"upper(coalesce({col}, 'NONE')) LIKE")


def size_sql(col: str) -> str:
    return (f"CASE WHEN {col} >= 0 AND {col} < 360000 THEN 'MICRO' "
            f"WHEN {col} >= 360000 AND {col} < 4800000 THEN 'PEQUENA' "
            f"WHEN {col} >= 4800000 AND {col} < 300000000 THEN 'MEDIA' "
            f"WHEN {col} >= 300000000 THEN 'GRANDE' ELSE 'MICRO' END")


CYCLE_CASE = ("CASE s WHEN 'MINERACAO' THEN 10 WHEN 'ENERGIA' THEN 15 WHEN 'PETROLEO' THEN 20 "
              "WHEN 'SIDERURGIA' THEN 12 WHEN 'CONSTRUCAO' THEN 7 WHEN 'MANUFATURA' THEN 8 WHEN 'QUIMICA' THEN 9 "
              "WHEN 'FARMACEUTICA' THEN 6 WHEN 'TECNOLOGIA' THEN 3 WHEN 'VAREJO' THEN 4 WHEN 'SERVICOS' THEN 3 "
              "WHEN 'ALIMENTACAO' THEN 5 ELSE 6 END")
CAPITAL_CASE = ("CASE WHEN s IN ('MINERACAO', 'ENERGIA', 'PETROLEO', 'SIDERURGIA', 'CONSTRUCAO', 'MANUFATURA') "
                "THEN 1 ELSE 0 END")


def age_sql(col: str) -> str:
    return (f"CASE WHEN {col} IS NULL THEN 5.0::DOUBLE "
            f"ELSE greatest(0.0::DOUBLE, date_diff('day', {col}, DATE '2001-09-01') / 365.25::DOUBLE) END")


CF = ["receita_mensal_media", "crescimento_mom_medio", "volatilidade_receita", "fluxo_liquido_medio",
      "consistencia_fluxo_positivo", "margem_media", "tendencia_receita", "coef_variacao_receita",
      "taxa_recuperacao"]

SUP_DBL = ["VL_FATU", "VL_SLDO", "idade_anos", "faturamento_normalizado", "receita_trend", "fluxo_trend",
           "receita_cv", "fluxo_cv", "consistencia_receita", "consistencia_fluxo", "receita_media", "fluxo_medio",
           "maturidade_relativa", "performance_vs_porte", "eficiencia_capital"]

CTES += [
    ("sf_tail", """
        SELECT ID, year_month, coalesce(receita_mensal, 0.0) AS rec, coalesce(fluxo_liquido, 0.0) AS flx,
               g_receita_mom AS g, vol_receita_3m AS v3
        FROM fem WHERE year_month IS NOT NULL
        QUALIFY row_number() OVER (PARTITION BY ID ORDER BY year_month DESC) <= 6"""),
    ("sf_x", """
        SELECT *, lag(g) OVER (PARTITION BY ID ORDER BY year_month) AS gp,
               row_number() OVER (PARTITION BY ID ORDER BY year_month) - 1 AS x
        FROM sf_tail"""),
    ("sfeat", """
        SELECT ID, avg(rec) AS receita_mensal_media, sum(rec) AS receita_total_periodo,
               CASE WHEN count(g) > 0 THEN avg(CASE WHEN isfinite(g) THEN g END) ELSE 0.0 END AS crescimento_mom_medio,
               CASE WHEN count(v3) > 0 THEN avg(coalesce(v3, 0.0)) ELSE stddev_samp(rec) END AS volatilidade_receita,
               avg(flx) AS fluxo_liquido_medio, avg(flx / (rec + 1e-6)) AS margem_media,
               regr_slope(rec, x) AS tendencia_receita,
               CASE WHEN avg(rec) > 0 THEN stddev_samp(rec) / (avg(rec) + 1e-6) ELSE 0.0 END AS coef_variacao_receita,
               count(CASE WHEN gp < -0.10 AND g > 0 THEN 1 END)
                 / (count(CASE WHEN g < -0.10 THEN 1 END) + 1e-6) AS taxa_recuperacao,
               avg(CAST(flx > 0 AS DOUBLE)) AS consistencia_fluxo_positivo,
               count(*) AS num_meses
        FROM sf_x GROUP BY ID HAVING count(*) >= 3"""),
    ("sc0", "SELECT ID, " + ", ".join(f"CASE WHEN isfinite({c}) THEN {c} END AS {c}" for c in CF) + " FROM sfeat"),
    ("sc_m", "SELECT " + ", ".join(f"quantile_cont({c}, 0.5) AS {c}" for c in CF) + " FROM sc0"),
    ("sc1", "SELECT sc0.ID, " + ", ".join(f"coalesce(sc0.{c}, sc_m.{c}) AS {c}" for c in CF) + " FROM sc0, sc_m"),
    ("sc_q", "SELECT " + ", ".join(f"quantile_cont({c}, 0.01) AS {c}_lo, quantile_cont({c}, 0.99) AS {c}_hi"
                                   for c in CF) + " FROM sc1"),
    ("sc2", "SELECT sc1.ID, " + ", ".join(f"least(greatest(sc1.{c}, sc_q.{c}_lo), sc_q.{c}_hi) AS {c}" for c in CF)
            + " FROM sc1, sc_q"),
    ("sc_r", "SELECT " + ", ".join(f"quantile_cont({c}, 0.25) AS {c}_a, quantile_cont({c}, 0.5) AS {c}_b, "
                                   f"quantile_cont({c}, 0.75) AS {c}_c" for c in CF) + " FROM sc2"),
    ("pf1", f"""
        SELECT ID, DT_REFE, VL_FATU, VL_SLDO, DT_ABRT, DS_CNAE, {age_sql('DT_ABRT')} AS idade_anos,
               s AS setor, {size_sql('VL_FATU')} AS porte,
               CASE WHEN VL_SLDO > 0 THEN 1 ELSE 0 END AS saude_saldo,
               ln(1 + coalesce(VL_FATU, 0.0)) AS faturamento_normalizado,
               {CYCLE_CASE} AS ciclo_setor_anos, {CAPITAL_CASE} AS capital_intensivo
        FROM (SELECT *, {sector_sql('DS_CNAE')} AS s FROM base1) b"""),
    ("bagg", """
        SELECT ID, count(*) AS num_meses_ativo, regr_slope(r, x) AS receita_trend, regr_slope(fl, x) AS fluxo_trend,
               stddev_samp(r) / (avg(r) + 1e-6) AS receita_cv, stddev_samp(fl) / (abs(avg(fl)) + 1e-6) AS fluxo_cv,
               avg(CAST(r > 0 AS DOUBLE)) AS consistencia_receita, avg(CAST(fl > 0 AS DOUBLE)) AS consistencia_fluxo,
               avg(r) AS receita_media, avg(fl) AS fluxo_medio
        FROM (SELECT ID, receita_mensal AS r, fluxo_liquido AS fl,
                     row_number() OVER (PARTITION BY ID ORDER BY year_month) - 1 AS x FROM flows) m
        GROUP BY ID HAVING count(*) >= 2"""),
    ("brel", """
        SELECT ID, count(DISTINCT payer) + count(DISTINCT payee) AS dv, count(DISTINCT ch) AS nc FROM (
          SELECT ID_RCBE AS ID, ID_PGTO AS payer, NULL AS payee, DS_TRAN AS ch FROM base2
          UNION ALL SELECT ID_PGTO, NULL, ID_RCBE, DS_TRAN FROM base2) x GROUP BY ID"""),
    ("sup0", """
        SELECT p.*, b.receita_trend, b.fluxo_trend, b.receita_cv, b.fluxo_cv, b.consistencia_receita,
               b.consistencia_fluxo, CAST(coalesce(r.dv, 0) AS BIGINT) AS diversificacao_contrapartes,
               CAST(coalesce(r.nc, 0) AS BIGINT) AS canais_utilizados, b.receita_media, b.fluxo_medio,
               CAST(b.num_meses_ativo AS BIGINT) AS num_meses_ativo,
               p.idade_anos / CASE WHEN p.ciclo_setor_anos = 0 THEN 1 ELSE p.ciclo_setor_anos END AS maturidade_relativa,
               b.receita_media / (p.VL_FATU / 12 + 1e-6) AS performance_vs_porte,
               b.fluxo_medio / (abs(p.VL_SLDO) + 1e-6) AS eficiencia_capital
        FROM pf1 p JOIN bagg b ON p.ID = b.ID LEFT JOIN brel r ON r.ID = p.ID"""),
    ("sup1", "SELECT * REPLACE (" + ", ".join(f"CASE WHEN isfinite({c}) THEN {c} END AS {c}" for c in SUP_DBL)
             + ") FROM sup0"),
    ("sup_m", "SELECT " + ", ".join(f"quantile_cont({c}, 0.5) AS {c}" for c in SUP_DBL)
              + ", (SELECT DT_ABRT FROM sup1 WHERE DT_ABRT IS NOT NULL GROUP BY DT_ABRT "
                "ORDER BY count(*) DESC, DT_ABRT LIMIT 1) AS dt_mode FROM sup1"),
    ("sup", "SELECT sup1.* REPLACE (" + ", ".join(f"coalesce(sup1.{c}, sup_m.{c}) AS {c}" for c in SUP_DBL)
            + ", coalesce(sup1.DT_ABRT, sup_m.dt_mode) AS DT_ABRT) FROM sup1, sup_m"),
    ("lab", """
        SELECT ID, DT_REFE, CASE
            WHEN idade_anos < 2 OR maturidade_relativa < 0.3 OR (porte = 'MICRO' AND idade_anos < 3) THEN 'Início'
            WHEN receita_trend > 0 AND consistencia_fluxo > 0.6 AND fluxo_medio > 0 AND maturidade_relativa >= 0.3
                 AND maturidade_relativa < 0.7 AND diversificacao_contrapartes >= 3 THEN 'Crescimento'
            WHEN maturidade_relativa >= 0.7 AND consistencia_fluxo > 0.7 AND abs(receita_trend) < 1000
                 AND diversificacao_contrapartes >= 5 AND fluxo_medio > 0 THEN 'Maturidade'
            WHEN fluxo_medio < 0 OR receita_trend < -1000 OR consistencia_fluxo < 0.3 THEN 'Declínio'
            ELSE 'Reestruturação' END AS label
        FROM sup"""),
    ("rstage", """
        SELECT l.ID, t.label AS estagio, avg(CAST(l.label = t.label AS DOUBLE)) AS confianca
        FROM lab l JOIN (SELECT ID, label FROM lab
                         QUALIFY row_number() OVER (PARTITION BY ID ORDER BY DT_REFE DESC) = 1) t ON l.ID = t.ID
        GROUP BY l.ID, t.label"""),
    ("summ", f"""
        SELECT g.*, CASE WHEN abs(g.receita_media) > 1e-9 THEN g.fluxo_medio / g.receita_media ELSE 0.0 END AS margem_media,
               b.DS_CNAE, b.VL_FATU, {size_sql('coalesce(b.VL_FATU, 0.0)')} AS porte,
               CASE WHEN b.DS_CNAE IS NULL OR regexp_extract(upper(b.DS_CNAE), '^([^-;|/]+)', 1) = '' THEN 'OUTROS'
                    ELSE regexp_extract(upper(b.DS_CNAE), '^([^-;|/]+)', 1) END AS setor,
               s.estagio
        FROM (SELECT ID, avg(receita_mensal) AS receita_media, avg(despesa_mensal) AS despesa_media,
                     avg(fluxo_liquido) AS fluxo_medio, sum(receita_mensal) AS receita_total,
                     avg(g_receita_mom) AS crescimento_medio, avg(vol_receita_3m) AS volatilidade_receita,
                     avg(CAST(fluxo_liquido > 0 AS DOUBLE)) AS consistencia_fluxo
              FROM rep GROUP BY ID) g
        LEFT JOIN (SELECT ID, DS_CNAE, VL_FATU FROM base1
                   QUALIFY row_number() OVER (PARTITION BY ID ORDER BY DT_REFE) = 1) b ON b.ID = g.ID
        LEFT JOIN rstage s ON s.ID = g.ID"""),
    ("cprof", """
        SELECT s.ID, s.receita_media, s.despesa_media, s.fluxo_medio, s.margem_media, s.receita_total,
               s.crescimento_medio, s.volatilidade_receita, s.consistencia_fluxo,
               l.idade_anos, l.maturidade_relativa, l.setor, l.porte, l.receita_trend, l.fluxo_trend,
               l.diversificacao_contrapartes, l.canais_utilizados, r.estagio, r.confianca
        FROM summ s
        JOIN (SELECT * FROM sup QUALIFY row_number() OVER (PARTITION BY ID ORDER BY DT_REFE DESC) = 1) l ON l.ID = s.ID
        LEFT JOIN rstage r ON r.ID = s.ID"""),
]

_reg("stage_features", "SELECT * FROM sfeat")
_reg("stage_features_clean", "SELECT sc2.ID, " + ", ".join(
    f"(sc2.{c} - sc_r.{c}_b) / CASE WHEN sc_r.{c}_c - sc_r.{c}_a = 0 THEN 1.0 ELSE sc_r.{c}_c - sc_r.{c}_a END AS {c}"
    for c in CF) + " FROM sc2, sc_r")
_reg("classify_sector", f"SELECT DISTINCT ID, DS_CNAE, {sector_sql('DS_CNAE')} AS setor FROM base1")
_reg("classify_size", f"SELECT ID, DT_REFE, VL_FATU, {size_sql('VL_FATU')} AS porte FROM base1")
_reg("company_age", f"SELECT ID, DT_ABRT, {age_sql('DT_ABRT')} AS idade_anos FROM (SELECT DISTINCT ID, DT_ABRT FROM base1) b")
_reg("sector_profile_lookup", f"""
    SELECT ID, s AS setor, {CYCLE_CASE} AS ciclo_setor_anos, {CAPITAL_CASE} AS capital_intensivo
    FROM (SELECT DISTINCT ID, {sector_sql('DS_CNAE')} AS s FROM base1) b""")
_reg("supervised_features", "SELECT * FROM sup")
_reg("business_labels", "SELECT * FROM lab")
_reg("rule_stages", "SELECT * FROM rstage")
_reg("ensemble_features", """
    SELECT ID, coalesce(receita_media, 0.0) AS receita_media, coalesce(despesa_media, 0.0) AS despesa_media,
           coalesce(fluxo_medio, 0.0) AS fluxo_medio, coalesce(margem_media, 0.0) AS margem_media,
           coalesce(receita_total, 0.0) AS receita_total, coalesce(crescimento_medio, 0.0) AS crescimento_medio,
           coalesce(volatilidade_receita, 0.0) AS volatilidade_receita,
           coalesce(consistencia_fluxo, 0.0) AS consistencia_fluxo,
           coalesce(idade_anos, 5.0) AS idade_anos, coalesce(maturidade_relativa, 0.5) AS maturidade_relativa,
           """ + ", ".join(f"CAST(setor = '{s}' AS DOUBLE) AS setor_{s}" for s in sorted(
               ["MINERACAO", "ENERGIA", "PETROLEO", "SIDERURGIA", "CONSTRUCAO", "MANUFATURA", "QUIMICA",
                "FARMACEUTICA", "TECNOLOGIA", "VAREJO", "SERVICOS", "ALIMENTACAO", "OUTROS"])) + """,
           CAST(CASE porte WHEN 'MICRO' THEN 0 WHEN 'PEQUENA' THEN 1 WHEN 'MEDIA' THEN 2 WHEN 'GRANDE' THEN 3
                ELSE 0 END AS DOUBLE) AS porte_encoded,
           coalesce(receita_trend, 0.0) AS receita_trend, coalesce(fluxo_trend, 0.0) AS fluxo_trend,
           coalesce(CAST(diversificacao_contrapartes AS DOUBLE), 0.0) AS diversificacao_contrapartes,
           coalesce(CAST(canais_utilizados AS DOUBLE), 1.0) AS canais_utilizados
    FROM cprof""")
_reg("ensemble_labels", """
    SELECT ID, CASE
        WHEN idade_anos < 2 OR (idade_anos < 3 AND receita_media < 50000) THEN 'Início'
        WHEN crescimento_medio > 0.1 AND consistencia_fluxo > 0.6 AND fluxo_medio > 0 AND margem_media > 0.05
          THEN 'Crescimento'
        WHEN abs(crescimento_medio) < 0.05 AND consistencia_fluxo > 0.7 AND fluxo_medio > 0 AND idade_anos > 5
          THEN 'Maturidade'
        WHEN fluxo_medio < -5000 OR (crescimento_medio < -0.1 AND consistencia_fluxo < 0.4) THEN 'Declínio'
        ELSE 'Reestruturação' END AS label
    FROM cprof""")

# ------------------------------------------------------------ sector
CTES += [
    ("sg", """
        SELECT setor, porte, GROUPING(setor, porte) AS gid,
               quantile_cont(receita_media, 0.25) AS r25, quantile_cont(receita_media, 0.5) AS r50,
               quantile_cont(receita_media, 0.75) AS r75,
               quantile_cont(margem_media, 0.25) AS m25, quantile_cont(margem_media, 0.5) AS m50,
               quantile_cont(margem_media, 0.75) AS m75,
               quantile_cont(crescimento_medio, 0.5) AS c50, quantile_cont(consistencia_fluxo, 0.5) AS k50,
               count(*) AS n, avg(CAST(coalesce(estagio IN ('Crescimento', 'Maturidade'), false) AS DOUBLE)) AS h
        FROM cprof GROUP BY ROLLUP (setor, porte)"""),
    ("smet", """
        SELECT s.setor, CASE WHEN s.gid = 1 THEN 'TODOS' ELSE s.porte END AS porte,
               CASE WHEN s.n < 3 THEN a.r25 ELSE s.r25 END AS receita_p25,
               CASE WHEN s.n < 3 THEN a.r50 ELSE s.r50 END AS receita_p50,
               CASE WHEN s.n < 3 THEN a.r75 ELSE s.r75 END AS receita_p75,
               CASE WHEN s.n < 3 THEN a.m25 ELSE s.m25 END AS margem_p25,
               CASE WHEN s.n < 3 THEN a.m50 ELSE s.m50 END AS margem_p50,
               CASE WHEN s.n < 3 THEN a.m75 ELSE s.m75 END AS margem_p75,
               CASE WHEN s.n < 3 THEN a.c50 ELSE s.c50 END AS crescimento_p50,
               CASE WHEN s.n < 3 THEN a.k50 ELSE s.k50 END AS fluxo_consistencia_p50,
               CASE WHEN s.n < 3 THEN a.n ELSE s.n END AS empresas_total,
               CASE WHEN s.n < 3 THEN a.h ELSE s.h END AS empresas_saudaveis_pct
        FROM sg s, (SELECT * FROM sg WHERE gid = 3) a WHERE s.gid < 3"""),
    ("plong", """
        SELECT ID, setor, porte, 'receita_media' AS metric, receita_media AS value FROM cprof
        UNION ALL SELECT ID, setor, porte, 'margem_media', margem_media FROM cprof
        UNION ALL SELECT ID, setor, porte, 'crescimento_medio', crescimento_medio FROM cprof
        UNION ALL SELECT ID, setor, porte, 'consistencia_fluxo', consistencia_fluxo FROM cprof"""),
    ("pgrp", """
        SELECT c.ID, c.setor, c.porte, sp.n AS n_sp, s.n AS n_s, sp.n < 5 AS wide
        FROM cprof c JOIN (SELECT setor, porte, count(*) AS n FROM cprof GROUP BY 1, 2) sp
               ON sp.setor = c.setor AND sp.porte = c.porte
             JOIN (SELECT setor, count(*) AS n FROM cprof GROUP BY 1) s ON s.setor = c.setor"""),
    ("prank", """
        SELECT a.ID, a.setor, a.porte, a.metric, a.value,
               CAST(CASE WHEN tot = 0 OR a.value IS NULL THEN 1 ELSE n_gt + 1 END AS BIGINT) AS rank,
               CAST(CASE WHEN tot = 0 THEN 1 ELSE tot END AS BIGINT) AS total,
               CAST(CASE WHEN tot = 0 THEN 50 WHEN a.value IS NULL THEN 0 ELSE floor(n_le / tot * 100) END AS BIGINT)
                 AS percentile,
               CASE WHEN tot = 0 THEN NULL
                    WHEN (CASE WHEN a.value IS NULL THEN 0 ELSE floor(n_le / tot * 100) END) >= 75 THEN 'Q1 (Top 25%)'
                    WHEN (CASE WHEN a.value IS NULL THEN 0 ELSE floor(n_le / tot * 100) END) >= 50 THEN 'Q2 (25-50%)'
                    WHEN (CASE WHEN a.value IS NULL THEN 0 ELSE floor(n_le / tot * 100) END) >= 25 THEN 'Q3 (50-75%)'
                    ELSE 'Q4 (Bottom 25%)' END AS quartile,
               CAST(CASE WHEN g.wide THEN g.n_s ELSE g.n_sp END AS BIGINT) AS peer_count
        FROM (SELECT a.ID, a.setor, a.porte, a.metric, a.value,
                     count(b.value) AS tot,
                     count(CASE WHEN b.value > a.value THEN 1 END) AS n_gt,
                     count(CASE WHEN b.value <= a.value THEN 1 END) AS n_le
              FROM plong a JOIN pgrp ga ON ga.ID = a.ID
                   JOIN plong b ON b.metric = a.metric AND b.setor = a.setor AND (ga.wide OR b.porte = a.porte)
              GROUP BY a.ID, a.setor, a.porte, a.metric, a.value) a
        JOIN pgrp g ON g.ID = a.ID"""),
    ("cscore", """
        SELECT ID, avg(percentile) AS competitive_score,
               CASE WHEN avg(percentile) >= 80 THEN 'Líder de Mercado' WHEN avg(percentile) >= 60 THEN 'Competidor Forte'
                    WHEN avg(percentile) >= 40 THEN 'Posição Mediana' WHEN avg(percentile) >= 20 THEN 'Desafiante'
                    ELSE 'Posição Frágil' END AS market_position,
               max(peer_count) AS peer_count
        FROM prank GROUP BY ID"""),
    ("swt", """
        SELECT c.ID,
               concat_ws(',', CASE WHEN coalesce(pr.percentile, 0) > 70 THEN 'revenue_above_p70' END,
                              CASE WHEN coalesce(pm.percentile, 0) > 70 THEN 'margin_above_most_peers' END,
                              CASE WHEN c.consistencia_fluxo > 0.8 THEN 'predictable_cash_flow' END) AS strengths,
               concat_ws(',', CASE WHEN coalesce(pg.percentile, 0) < 30 THEN 'growth_below_sector' END,
                              CASE WHEN c.fluxo_medio < 0 THEN 'negative_cash_flow' END) AS weaknesses,
               concat_ws(',', CASE WHEN m.empresas_saudaveis_pct > 0.6 THEN 'expanding_sector' END,
                              CASE WHEN c.porte IN ('MICRO', 'PEQUENA') THEN 'room_to_grow_in_size' END) AS opportunities,
               concat_ws(',', CASE WHEN m.empresas_saudaveis_pct < 0.3 THEN 'sector_in_difficulty' END,
                              CASE WHEN k.peer_count > 100 THEN 'high_competition' END) AS threats
        FROM cprof c
        LEFT JOIN prank pr ON pr.ID = c.ID AND pr.metric = 'receita_media'
        LEFT JOIN prank pm ON pm.ID = c.ID AND pm.metric = 'margem_media'
        LEFT JOIN prank pg ON pg.ID = c.ID AND pg.metric = 'crescimento_medio'
        LEFT JOIN smet m ON m.setor = c.setor AND m.porte = c.porte
        LEFT JOIN cscore k ON k.ID = c.ID"""),
]

_reg("sector_metrics", "SELECT * FROM smet")
_reg("peer_ranking", "SELECT * FROM prank")
_reg("competitive_score", "SELECT * FROM cscore")
_reg("swot", "SELECT * FROM swt")
_reg("competitive_analysis", """
    SELECT c.ID, c.setor, c.porte, m.receita_p50, m.margem_p50, m.empresas_total, m.empresas_saudaveis_pct,
           k.competitive_score, k.market_position, k.peer_count, w.strengths, w.weaknesses, w.opportunities, w.threats
    FROM cprof c LEFT JOIN smet m ON m.setor = c.setor AND m.porte = c.porte
    LEFT JOIN cscore k ON k.ID = c.ID LEFT JOIN swt w ON w.ID = c.ID""")
_reg("sector_evolution", f"""
    SELECT setor, year_month, receita_media, margem_media, consistencia_fluxo, empresas_ativas,
           CASE WHEN nm > 1 THEN
             CASE WHEN prev IS NULL THEN NULL WHEN prev <> 0 THEN receita_media / prev - 1
                  WHEN receita_media > 0 THEN CAST('inf' AS DOUBLE) WHEN receita_media < 0 THEN CAST('-inf' AS DOUBLE) END
           END AS receita_trend,
           CASE WHEN nm > 1 THEN margem_media - prev_m END AS margem_trend
    FROM (SELECT *, lag(receita_media) OVER (PARTITION BY setor ORDER BY year_month) AS prev,
                 lag(margem_media) OVER (PARTITION BY setor ORDER BY year_month) AS prev_m,
                 count(*) OVER (PARTITION BY setor) AS nm
          FROM (SELECT setor, year_month, avg(receita_mensal) AS receita_media,
                       avg(CASE WHEN abs(receita_mensal) > 1e-9 THEN fluxo_liquido / receita_mensal ELSE 0.0 END)
                         AS margem_media,
                       avg(CAST(fluxo_liquido > 0 AS DOUBLE)) AS consistencia_fluxo, count(ID) AS empresas_ativas
                FROM (SELECT *, {sector_sql('DS_CNAE')} AS setor FROM fem) h GROUP BY 1, 2) g) x""")

# ------------------------------------------------------------ dashboard-1 queries
_reg("company_summary", "SELECT * FROM summ")
_reg("period_kpis", """
    SELECT k.*, coalesce(s.estagio, 'N/D') AS estagio,
           CASE WHEN s.estagio IS NULL THEN 0.5 ELSE s.confianca END AS confianca
    FROM (SELECT ID, sum(receita_mensal) AS receita_total, sum(despesa_mensal) AS despesa_total,
                 sum(fluxo_liquido) AS fluxo_total, avg(g_receita_mom) * 100 AS crescimento_pct,
                 avg(CAST(fluxo_liquido > 0 AS DOUBLE)) * 100 AS consistencia_pct,
                 avg(vol_receita_3m) AS volatilidade_media, count(DISTINCT year_month) AS n_meses,
                 CASE WHEN sum(receita_mensal) > 0 THEN sum(fluxo_liquido) / sum(receita_mensal) * 100 ELSE 0.0 END
                   AS margem_pct
          FROM rep GROUP BY ID) k LEFT JOIN rstage s ON s.ID = k.ID""")
_reg("financial_composition", """
    SELECT ID, sum(despesa_mensal) AS despesas, greatest(0.0, sum(receita_mensal) - sum(despesa_mensal)) AS lucro
    FROM rep GROUP BY ID""")
_reg("flow_deltas", """
    SELECT ID, year_month, ym_str, delta FROM (
      SELECT ID, year_month, ym_str, count(*) OVER (PARTITION BY ID) AS n,
             CASE WHEN lag(fluxo_liquido) OVER w IS NULL THEN fluxo_liquido
                  ELSE fluxo_liquido - lag(fluxo_liquido) OVER w END AS delta
      FROM rep WINDOW w AS (PARTITION BY ID ORDER BY year_month)) x WHERE n >= 2""")
_reg("revenue_growth_pairs", """
    SELECT ID, ym_str, receita_mensal AS receita, g_receita_mom * 100 AS crescimento_pct, fluxo_liquido AS fluxo
    FROM rep""")
_reg("radar_scores", """
    SELECT ID, least(greatest(receita_media / 100000 * 100, 0.0), 100.0) AS receita,
           least(greatest(50.0 + crescimento_medio * 100, 0.0), 100.0) AS crescimento,
           least(greatest(50.0 + margem_media * 100, 0.0), 100.0) AS margem,
           least(greatest(consistencia_fluxo * 100, 0.0), 100.0) AS consistencia,
           least(greatest(100.0 - volatilidade_receita, 0.0), 100.0) AS eficiencia
    FROM summ""")
_CM = ["receita_mensal", "despesa_mensal", "fluxo_liquido", "g_receita_mom", "vol_receita_3m"]
_reg("metric_correlation", "SELECT ID, metric_a, metric_b, "
     "CASE WHEN c IS NULL OR isnan(c) THEN NULL ELSE round_even(c, 2) END AS corr FROM (" + " UNION ALL ".join(
         f"SELECT ID, '{a}' AS metric_a, '{b}' AS metric_b, corr({a}, {b}) AS c FROM rep GROUP BY ID"
         for a in _CM for b in _CM) + ") x")
_reg("simple_competitive_score", """
    SELECT c.ID, CASE WHEN s.ID IS NULL THEN 50.0 ELSE
             least(greatest(s.receita_media / 100000 * 30, 0.0), 30.0)
             + least(greatest(15.0 + s.crescimento_medio * 50, 0.0), 30.0)
             + least(greatest(s.consistencia_fluxo * 40, 0.0), 40.0) END AS score
    FROM companies c LEFT JOIN summ s ON s.ID = c.ID""")
_reg("trend_series", """
    SELECT ID, year_month, ym_str, receita_mensal AS receita,
           CASE WHEN count(*) OVER p > 1 THEN regr_intercept(receita_mensal, x) OVER p
                                             + regr_slope(receita_mensal, x) OVER p * x END AS tendencia,
           g_receita_mom * 100 AS crescimento_pct, vol_receita_3m AS volatilidade,
           avg(CAST(fluxo_liquido > 0 AS DOUBLE)) OVER (PARTITION BY ID ORDER BY year_month
                                                       ROWS BETWEEN 2 PRECEDING AND CURRENT ROW) * 100 AS consistencia_pct
    FROM (SELECT *, CAST(row_number() OVER (PARTITION BY ID ORDER BY year_month) - 1 AS DOUBLE) AS x FROM rep) r
    WINDOW p AS (PARTITION BY ID)""")
_reg("period_insights", """
    SELECT g.ID, coalesce(s.estagio, 'N/D') AS estagio,
           concat_ws(',',
             CASE WHEN n > 1 AND slope > 1000 THEN 'revenue_trend_up' END,
             CASE WHEN n > 1 AND slope < -1000 THEN 'revenue_trend_down' END,
             CASE WHEN n <= 1 THEN 'revenue_stable' END,
             CASE WHEN pos >= 0.8 THEN 'consistent_positive_flow' END,
             CASE WHEN pos < 0.5 THEN 'negative_flow_majority' END,
             CASE WHEN margin > 0.2 THEN 'healthy_margin' END,
             CASE WHEN margin < 0 THEN 'negative_margin' END,
             CASE WHEN strip_accents(coalesce(s.estagio, 'N/D')) = 'Inicio' THEN 'recs_start' END,
             CASE WHEN strip_accents(coalesce(s.estagio, 'N/D')) = 'Crescimento' THEN 'recs_growth' END,
             CASE WHEN strip_accents(coalesce(s.estagio, 'N/D')) = 'Maturidade' THEN 'recs_maturity' END,
             CASE WHEN strip_accents(coalesce(s.estagio, 'N/D')) = 'Declinio' THEN 'recs_decline' END) AS insights
    FROM (SELECT ID, count(*) AS n, regr_slope(receita_mensal, x) AS slope,
                 avg(CAST(fluxo_liquido > 0 AS DOUBLE)) AS pos,
                 sum(fluxo_liquido) / (sum(receita_mensal) + 1e-9) AS margin
          FROM (SELECT *, row_number() OVER (PARTITION BY ID ORDER BY year_month) - 1 AS x FROM rep) r
          GROUP BY ID) g LEFT JOIN rstage s ON s.ID = g.ID""")

# ------------------------------------------------------------ insight codes
_reg("contextual_insights", """
    SELECT ID, estagio, concat_ws(',',
        CASE WHEN st = 'Inicio' THEN 'start_focus_validation' END,
        CASE WHEN st = 'Inicio' AND age < 2 THEN 'start_young_company' END,
        CASE WHEN st = 'Inicio' AND sz = 'MICRO' THEN 'start_micro_programs' END,
        CASE WHEN st = 'Inicio' AND flow < 0 THEN 'start_negative_flow_watch_burn' END,
        CASE WHEN st = 'Crescimento' THEN 'growth_focus_scalability' END,
        CASE WHEN st = 'Crescimento' AND cons > 0.8 THEN 'growth_consistent_expand' END,
        CASE WHEN st = 'Crescimento' AND cons <= 0.8 AND cons < 0.6 THEN 'growth_inconsistent_review_costs' END,
        CASE WHEN st = 'Crescimento' AND rev > 100000 THEN 'growth_high_revenue_diversify' END,
        CASE WHEN st = 'Maturidade' THEN 'maturity_focus_efficiency' END,
        CASE WHEN st = 'Maturidade' AND cons > 0.9 THEN 'maturity_very_stable_invest' END,
        CASE WHEN st = 'Maturidade' THEN 'maturity_continuous_innovation' END,
        CASE WHEN st = 'Declinio' THEN 'decline_recovery_plan' END,
        CASE WHEN st = 'Declinio' AND flow < -10000 THEN 'decline_renegotiate_debt' END,
        CASE WHEN st = 'Declinio' AND cons < 0.3 THEN 'decline_daily_cash_control' END,
        CASE WHEN st = 'Reestruturacao' THEN 'restructuring_monitor' END,
        CASE WHEN st = 'Reestruturacao' AND flow > 0 THEN 'restructuring_positive_flow' END,
        CASE WHEN st = 'Reestruturacao' AND cons > 0.5 THEN 'restructuring_consistency_improving' END,
        CASE WHEN conf < 0.6 THEN 'model_confidence_low' END,
        CASE WHEN conf >= 0.6 AND conf > 0.9 THEN 'model_confidence_high' END) AS insights
    FROM (SELECT ID, estagio, strip_accents(estagio) AS st, coalesce(idade_anos, 0.0) AS age,
                 coalesce(porte, 'MICRO') AS sz, coalesce(fluxo_medio, 0.0) AS flow,
                 coalesce(consistencia_fluxo, 0.0) AS cons, coalesce(receita_media, 0.0) AS rev,
                 coalesce(confianca, 0.0) AS conf FROM cprof) c""")
_reg("comparative_benchmarks", """
    SELECT ID, coalesce(setor, 'OUTROS') AS setor, coalesce(porte, 'MICRO') AS porte,
           concat_ws(',', 'sector_benchmark',
                     CASE WHEN coalesce(receita_media, 0.0) > 50000 THEN 'revenue_above_peer_average' END,
                     CASE WHEN coalesce(receita_media, 0.0) < 10000 THEN 'revenue_below_average' END) AS benchmarks
    FROM cprof""")
_REC = {"Inicio": ["weekly_cash_control", "track_traction_metrics", "seek_microcredit"],
        "Crescimento": ["executive_kpi_dashboard", "professionalise_processes", "working_capital_credit"],
        "Maturidade": ["innovation_programme", "adjacent_markets", "automation_digital"],
        "Declinio": ["daily_cash_tracking", "cut_non_essential_costs", "renegotiate_terms"],
        "Reestruturacao": ["ninety_day_plan", "transparent_communication", "focus_core_business"]}
_reg("actionable_recommendations", "SELECT ID, estagio, concat_ws(','" + "".join(
    f", CASE WHEN st = '{k}' THEN '{r}' END" for k, rs in _REC.items() for r in rs) + """,
        CASE WHEN cons < 0.4 AND st IN ('Crescimento', 'Maturidade') THEN 'tighten_expense_control' END,
        CASE WHEN flow < 0 AND coalesce(st, '') <> 'Declinio' THEN 'cash_before_investment' END) AS recommendations
    FROM (SELECT ID, estagio, strip_accents(estagio) AS st, coalesce(consistencia_fluxo, 0.0) AS cons,
                 coalesce(fluxo_medio, 0.0) AS flow FROM cprof) c""")


# ------------------------------------------------------------ report formatting
def _fmt(x: str, spec: str) -> str:
    return f"format('{{:{spec}}}', {x})"


def brl_sql(x: str) -> str:
    return (f"CASE WHEN {x} IS NULL OR isnan({x}) THEN 'R$ 0' "
            f"WHEN isinf({x}) AND {x} > 0 THEN 'R$ inf' WHEN isinf({x}) THEN 'R$ -inf' "
            f"ELSE translate('R$ ' || CASE WHEN abs({x}) >= 1000000 THEN {_fmt(f'{x} / 1000000', '.1f')} || 'M' "
            f"WHEN abs({x}) >= 1000 THEN {_fmt(f'{x} / 1000', '.1f')} || 'K' "
            f"ELSE {_fmt(x, ',.0f')} END, ',.', '.,') END")


def pct_sql(x: str) -> str:
    y = f"({x}) * 100"
    return (f"CASE WHEN ({x}) IS NULL OR isnan({x}) THEN '0,0%' "
            f"WHEN isinf({y}) AND {y} > 0 THEN 'inf%' WHEN isinf({y}) THEN '-inf%' "
            f"ELSE translate({_fmt(y, ',.1f')} || '%', ',.', '.,') END")


def num_sql(x: str, p: int) -> str:
    return (f"CASE WHEN {x} IS NULL OR isnan({x}) THEN '-' "
            f"WHEN isinf({x}) AND {x} > 0 THEN 'inf' WHEN isinf({x}) THEN '-inf' "
            f"ELSE translate({_fmt(x, f',.{p}f')}, ',.', '.,') END")


def unit_pct_sql(x: str) -> str:
    return f"CASE WHEN abs({x}) <= 1 THEN {pct_sql(x)} ELSE {pct_sql(f'{x} / 100')} END"


_reg("format_report", "SELECT ID, year_month, " + ", ".join(
    [f"{brl_sql(c)} AS {c}" for c in ["VL_FATU", "VL_SLDO", "receita_mensal", "despesa_mensal", "fluxo_liquido"]]
    + [f"{unit_pct_sql('g_receita_mom')} AS g_receita_mom", f"{brl_sql('vol_receita_3m')} AS vol_receita_3m"])
    + " FROM fem")

# metric, label, unit, description, formatted-sql-template, polarity kind (hi/lo/neutral)
_CARDS = [
    ("receita_mensal_media", "Receita Mensal Media", "", "Company financial metric", "num", "n"),
    ("crescimento_mom_medio", "Crescimento Médio MoM", "%", "Company financial metric", "pct", "hi"),
    ("volatilidade_receita", "Volatilidade da Receita", "R$", "Company financial metric", "brl", "lo"),
    ("fluxo_liquido_medio", "Fluxo Liquido Medio", "", "Company financial metric", "num", "n"),
    ("consistencia_fluxo_positivo", "Consistência de Fluxo+", "%", "Share of months with positive net flow", "pct", "hi"),
    ("margem_media", "Margem Operacional", "%", "Average net flow relative to revenue", "pct", "hi"),
    ("tendencia_receita", "Tendência de Receita", "", "Slope of the linear revenue trend", "num", "n"),
    ("coef_variacao_receita", "Coeficiente de Variação", "", "Company financial metric", "num", "lo"),
    ("taxa_recuperacao", "Taxa de Recuperação", "%", "Rebounds after strong revenue drops", "pct", "hi"),
    ("num_meses", "Meses Analisados", "meses", "Company financial metric", "meses", "n"),
]


def _card_fmt(kind: str, x: str) -> str:
    return {"num": num_sql(x, 2), "pct": unit_pct_sql(x), "brl": brl_sql(x),
            "meses": num_sql(x, 0) + " || ' meses'"}[kind]


def _polarity(kind: str, x: str) -> str:
    if kind == "hi":
        p = f"CASE WHEN {x} > 0 THEN 'positive' ELSE 'negative' END"
    elif kind == "lo":
        p = f"CASE WHEN {x} > 0.3 THEN 'negative' ELSE 'positive' END"
    else:
        p = "'neutral'"
    return f"CASE WHEN {x} IS NULL OR isnan({x}) THEN 'neutral' ELSE {p} END"


_reg("metric_cards", " UNION ALL ".join(
    f"SELECT ID, '{m}' AS metric, '{lab}' AS label, CAST({m} AS DOUBLE) AS value, "
    f"{_card_fmt(kind, f'CAST({m} AS DOUBLE)')} AS formatted, {_polarity(pol, f'CAST({m} AS DOUBLE)')} AS polarity, "
    f"'{unit}' AS unit, '{desc}' AS description FROM sfeat"
    for m, lab, unit, desc, kind, pol in _CARDS))
_reg("kpi_summary", f"""
    SELECT f.ID, 'estagio' AS metric, 'Estágio Empresarial' AS label, CAST(NULL AS DOUBLE) AS value,
           s.estagio AS formatted, '' AS unit
    FROM sfeat f LEFT JOIN rstage s ON s.ID = f.ID
    UNION ALL
    SELECT f.ID, 'confianca', 'Confiança do Modelo', s.confianca, {unit_pct_sql('s.confianca')}, '%'
    FROM sfeat f LEFT JOIN rstage s ON s.ID = f.ID
    UNION ALL
    SELECT ID, 'fluxo_liquido_medio', 'Fluxo Liquido Medio', fluxo_liquido_medio, {num_sql('fluxo_liquido_medio', 2)}, ''
    FROM sfeat
    UNION ALL
    SELECT ID, 'crescimento_mom_medio', 'Crescimento Médio MoM', crescimento_mom_medio,
           {unit_pct_sql('crescimento_mom_medio')}, '%'
    FROM sfeat""")
_reg("rename_for_display", """
    SELECT ID AS "Id", ym_str AS "Mes Referencia", receita_mensal AS "Receita Mensal",
           despesa_mensal AS "Despesa Mensal", fluxo_liquido AS "Fluxo de Caixa", g_receita_mom AS "Crescimento MoM"
    FROM rep""")


PAGERANK_STEPS = 10
_reg("pagerank_steps", "SELECT node AS node_id, r AS pagerank FROM pr%d" % PAGERANK_STEPS, [
    ("prt", "SELECT src, dst, v / sum(v) OVER (PARTITION BY src) AS p FROM pairs WHERE v > 0"),
    ("prn", "SELECT node, (SELECT count(*) FROM (SELECT src FROM prt UNION SELECT dst FROM prt) x) AS n, "
            "node NOT IN (SELECT src FROM prt) AS dangling FROM (SELECT src AS node FROM prt UNION SELECT dst FROM prt) y"),
    ("pr0", "SELECT node, n, dangling, CAST(1 AS DOUBLE) / n AS r FROM prn"),
    *[(f"pr{i}", f"""
        SELECT a.node, a.n, a.dangling, (1.0 - 0.85) / a.n
               + 0.85 * coalesce((SELECT sum(r) FROM pr{i - 1} WHERE dangling), 0.0) / a.n + 0.85 * coalesce(c.s, 0.0) AS r
        FROM pr{i - 1} a LEFT JOIN (SELECT t.dst, sum(t.p * b.r) AS s FROM prt t JOIN pr{i - 1} b ON b.node = t.src GROUP BY 1) c
          ON c.dst = a.node""") for i in range(1, PAGERANK_STEPS + 1)]])


def build(name: str, digits: dict[str, int]) -> str:
    body, extra = BODIES[name]
    ctes = {**dict(CTES), **dict(extra)}  # an extra one may stand for a shared one
    with_sql = ",\n".join(f"{n} AS ({s})" for n, s in ctes.items())
    if digits:
        repl = ", ".join(
            f'CASE WHEN round("{c}" + {3.14159 * 10.0 ** (-(d + 3))!r}, {d}) = 0 THEN 0.0::DOUBLE '
            f'ELSE round("{c}" + {3.14159 * 10.0 ** (-(d + 3))!r}, {d}) END AS "{c}"' for c, d in digits.items())
        return f"WITH {with_sql}\nSELECT * REPLACE ({repl}) FROM ({body}) q"
    return f"WITH {with_sql}\n{body}"


def oracle_sql(digits_by_name: dict[str, dict[str, int]]) -> dict[str, str]:
    return {n: build(n, digits_by_name.get(n, {})) for n in BODIES if n in digits_by_name}
