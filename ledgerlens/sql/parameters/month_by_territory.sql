-- Shipped orders and their amount per territory in one month (:month, as yyyymm).
-- Amounts are summed as decimals, so that the total does not depend on the order of the rows.
SELECT date_format(make_date(:month div 100, :month % 100, 1), 'yyyy-MM') AS mes,
       t.name_t AS nombreterritorio,
       count(*) AS ordenes,
       CAST(sum(CAST(h.totaldue AS DECIMAL(28, 10))) AS DOUBLE) AS monto
FROM sales_salesorderheader h JOIN sales_salesterritory t ON h.territoryid = t.territoryid
WHERE h.status = :status
  AND h.orderdate >= make_date(:month div 100, :month % 100, 1)
  AND h.orderdate < add_months(make_date(:month div 100, :month % 100, 1), 1)
GROUP BY t.name_t
