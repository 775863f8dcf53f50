-- Per month and customer with a purchase: last purchase of the month and the
-- days back to the two purchases before it (whole history).  Only the three
-- latest purchases of each (customer, month) can be those predecessors, so
-- the history window runs over at most three rows per active month.
WITH kept AS (
  SELECT customerid, salesorderid, orderdate, mes, r
  FROM (
    SELECT customerid, salesorderid, orderdate, year(orderdate) * 100 + month(orderdate) AS mes,
           row_number() OVER (PARTITION BY customerid, year(orderdate) * 100 + month(orderdate)
                              ORDER BY orderdate DESC, salesorderid DESC) AS r
    FROM sales_salesorderheader) x
  WHERE r <= 3
),
hist AS (
  SELECT mes, customerid, r, to_date(orderdate) AS last_date,
         to_date(lag(orderdate, 1) OVER (PARTITION BY customerid ORDER BY orderdate, salesorderid)) AS prev_date,
         to_date(lag(orderdate, 2) OVER (PARTITION BY customerid ORDER BY orderdate, salesorderid)) AS prev2_date
  FROM kept
)
SELECT format_string('%04d-%02d', h.mes DIV 100, h.mes % 100) AS mes, h.customerid,
       concat_ws(' ', nullif(pers.title, ''), nullif(pers.firstname_t, ''), nullif(pers.middlename_t, ''),
                 nullif(pers.lastname_t, '')) AS nombrecliente,
       h.last_date AS fechaultcompra,
       CAST(datediff(h.last_date, h.prev_date) AS BIGINT) AS diasuc_pc,
       CAST(datediff(h.prev_date, h.prev2_date) AS BIGINT) AS diaspc_apc
FROM hist h
JOIN sales_customer cust ON cust.customerid = h.customerid
JOIN person_person pers ON pers.businessentityid = cust.personid
WHERE h.r = 1
