-- Per code: how many positions k have that code at k, k-1 and k-2 of
-- secuencial (codes with no such run are listed with 0).
-- Rows are collapsed to (range of the key, key, code, count).  A range holds
-- 16384 positions; the last two of a range also look on from the next range.
-- Two windows per range then give the neighbours, without a join.
WITH collapsed AS (
  SELECT secuencial AS k, codigo, count(*) AS n
  FROM secuenciales
  WHERE secuencial IS NOT NULL
  GROUP BY secuencial, codigo
),
ranged AS (
  SELECT explode(CASE WHEN pmod(k, 16384) >= 16382 THEN array(floor(k / 16384), floor(k / 16384) + 1)
                      ELSE array(floor(k / 16384)) END) AS b,
         k, codigo, n
  FROM collapsed
),
neighbours AS (
  SELECT /*+ REPARTITION(b) */ * FROM ranged
),
looked AS (
  SELECT b, k, codigo, n,
         coalesce(sum(n) OVER (PARTITION BY b, codigo ORDER BY k RANGE BETWEEN 1 PRECEDING AND 1 PRECEDING), 0) AS one_back,
         coalesce(sum(n) OVER (PARTITION BY b, codigo ORDER BY k RANGE BETWEEN 2 PRECEDING AND 2 PRECEDING), 0) AS two_back,
         count(*) OVER (PARTITION BY b ORDER BY k RANGE BETWEEN 1 PRECEDING AND 1 PRECEDING) AS any_one_back,
         count(*) OVER (PARTITION BY b ORDER BY k RANGE BETWEEN 2 PRECEDING AND 2 PRECEDING) AS any_two_back
  FROM neighbours
)
SELECT codigo, CAST(sum(n * one_back * two_back) AS BIGINT) AS cantidad_veces_seguidos
FROM looked
WHERE b = floor(k / 16384) AND any_one_back > 0 AND any_two_back > 0
GROUP BY codigo
ORDER BY cantidad_veces_seguidos DESC, codigo
