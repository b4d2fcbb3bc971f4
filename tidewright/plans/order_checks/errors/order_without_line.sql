SELECT o_orderkey
FROM orders LEFT ANTI JOIN lineitem ON o_orderkey = l_orderkey;
