-- Transactions and amounts per month, territory and status (1..6).
-- Orders are aggregated per status first; that small result is turned into
-- columns.  Amounts are summed as decimals wide enough for any amount, so the
-- sum is exact and does not depend on its order.
WITH per_status AS (
  SELECT year(o.orderdate) * 100 + month(o.orderdate) AS m, t.name_t AS nombreterritorio, o.status,
         count(*) AS n, sum(CAST(o.totaldue AS DECIMAL(28,10))) AS amount
  FROM sales_salesterritory t
  JOIN sales_salesorderheader o USING (territoryid)
  GROUP BY ALL
),
wide AS (
  SELECT * FROM per_status
  PIVOT (max(n) AS n, max(amount) AS mnt FOR status IN (1 AS s1, 2 AS s2, 3 AS s3, 4 AS s4, 5 AS s5, 6 AS s6))
)
SELECT format_string('%04d-%02d', m DIV 100, m % 100) AS mes, nombreterritorio,
       ifnull(s1_n, 0L) AS trproceso, ifnull(s2_n, 0L) AS traprobadas, ifnull(s3_n, 0L) AS tratrasadas,
       ifnull(s4_n, 0L) AS trrechazadas, ifnull(s5_n, 0L) AS trenviadas, ifnull(s6_n, 0L) AS trcanceladas,
       CAST(ifnull(s1_mnt, 0) AS DOUBLE) AS mntproceso, CAST(ifnull(s2_mnt, 0) AS DOUBLE) AS mntaprobadas,
       CAST(ifnull(s3_mnt, 0) AS DOUBLE) AS mntatrasadas, CAST(ifnull(s4_mnt, 0) AS DOUBLE) AS mntrechazadas,
       CAST(ifnull(s5_mnt, 0) AS DOUBLE) AS mntenviadas, CAST(ifnull(s6_mnt, 0) AS DOUBLE) AS mntcanceladas
FROM wide
