SELECT c_custkey FROM customer WHERE c_acctbal < 0;
