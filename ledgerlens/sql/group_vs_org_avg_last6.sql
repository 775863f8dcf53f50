-- Territory groups against the organisation for the last six months present
-- in the orders (group - organisation; 'Above' when the group is higher).
-- The six months are a six-row key set: a broadcast semi-join.
WITH last6 AS (
  SELECT m FROM (
    SELECT DISTINCT year(orderdate) * 100 + month(orderdate) AS m FROM sales_salesorderheader) months
  ORDER BY m DESC LIMIT 6
),
per_group AS (
  SELECT year(hdr.orderdate) * 100 + month(hdr.orderdate) AS m, terr.group_t AS territorygroup,
         sum(CAST(hdr.subtotal AS DECIMAL(28,10))) AS s, count(hdr.subtotal) AS n
  FROM sales_salesorderheader hdr
  JOIN sales_salesterritory terr USING (territoryid)
  WHERE year(hdr.orderdate) * 100 + month(hdr.orderdate) IN (SELECT m FROM last6)
  GROUP BY 1, 2
),
avgs AS (
  SELECT m, territorygroup,
         try_divide(CAST(s AS DOUBLE), n) AS group_avg,
         try_divide(CAST(sum(s) OVER (PARTITION BY m) AS DOUBLE),
                    sum(n) OVER (PARTITION BY m)) AS monthavg
  FROM per_group
)
SELECT format_string('%04d-%02d', m DIV 100, m % 100) AS ordermonth, territorygroup, monthavg, group_avg - monthavg AS diff,
       CASE WHEN group_avg - monthavg > 0 THEN 'Above'
            WHEN group_avg - monthavg = 0 THEN 'Equal'
            ELSE 'Below' END AS indicator
FROM avgs
