"""clausemill: a Spark-native builder of labelled contract-clause corpora."""
