SELECT o_orderkey, o_custkey, o_totalprice, o_orderpriority, 'in sales.orders' AS origin, o_orderdate
FROM {schema}.{table_name}
WHERE o_orderstatus IN ('O', 'P')
ORDER BY o_orderdate DESC, o_orderkey DESC
