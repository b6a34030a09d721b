"""claimloom: Spark-first canonicalisation of text claims."""
