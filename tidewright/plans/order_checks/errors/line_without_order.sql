SELECT l_orderkey, l_linenumber
FROM lineitem LEFT ANTI JOIN orders ON l_orderkey = o_orderkey;
