"""simrec: set similarity (exact Jaccard, MinHash + banded LSH) and rating
prediction (user/item collaborative filtering, ALS) as Spark DataFrame jobs."""
