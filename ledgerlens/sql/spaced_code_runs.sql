-- Rows at positions n-4, n-2 and n that share one code, all columns of the
-- three rows, ordered by the last position.  Equal rows are joined once, with
-- their number, and written out as often as they combine.
WITH counted AS (
  SELECT secuencial, codigo, count(*) AS n FROM secuenciales
  WHERE secuencial IS NOT NULL AND codigo IS NOT NULL
  GROUP BY secuencial, codigo
),
ahead AS (
  SELECT codigo, secuencial + 4 AS at4, secuencial + 2 AS at2, secuencial, n FROM counted
),
triples AS (
  SELECT c.secuencial - 4 AS first_secuencial, c.secuencial - 2 AS middle_secuencial, c.secuencial AS last_secuencial,
         c.codigo, two.n AS n_middle, four.n AS n_first, explode(sequence(1L, c.n)) AS i
  FROM counted c
  JOIN ahead two ON two.codigo = c.codigo AND two.at2 = c.secuencial
  JOIN ahead four ON four.codigo = c.codigo AND four.at4 = c.secuencial
),
middles AS (
  SELECT /*+ REPARTITION(last_secuencial, codigo, i) */ *, explode(sequence(1L, n_middle)) AS j FROM triples
),
spread AS (
  SELECT *, explode(sequence(1L, n_first)) AS h FROM middles
)
SELECT first_secuencial, codigo AS first_codigo, middle_secuencial, codigo AS middle_codigo,
       last_secuencial, codigo AS last_codigo
FROM spread
ORDER BY last_secuencial, codigo, i, j, h
