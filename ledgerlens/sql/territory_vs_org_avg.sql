-- Organisation's monthly average subtotal against each territory's, in one
-- scan: sums and counts per (month, territory), month totals as a window over
-- that small aggregate.
WITH per_territory AS (
  SELECT year(hdr.orderdate) * 100 + month(hdr.orderdate) AS m, terr.name_t AS nombreterritorio,
         sum(CAST(hdr.subtotal AS DECIMAL(28,10))) AS s, count(hdr.subtotal) AS n
  FROM sales_salesorderheader hdr
  JOIN sales_salesterritory terr USING (territoryid)
  GROUP BY 1, 2
),
avgs AS (
  SELECT m, nombreterritorio,
         try_divide(CAST(s AS DOUBLE), n) AS territory_avg,
         try_divide(CAST(sum(s) OVER (PARTITION BY m) AS DOUBLE),
                    sum(n) OVER (PARTITION BY m)) AS monthavg
  FROM per_territory
)
SELECT format_string('%04d-%02d', m DIV 100, m % 100) AS mes, nombreterritorio, monthavg,
       monthavg - territory_avg AS diff,
       CASE WHEN monthavg - territory_avg > 0 THEN 'Above'
            WHEN monthavg - territory_avg = 0 THEN 'Equal'
            ELSE 'Below' END AS indicador
FROM avgs
