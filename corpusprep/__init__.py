"""corpusprep: Spark jobs that prepare bilingual and code-mixed text corpora."""
