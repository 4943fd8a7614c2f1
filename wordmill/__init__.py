"""wordmill: news-corpus preparation and classification as Spark jobs.

Every public function takes and returns DataFrames or Columns; nothing collects rows whose number
grows with the corpus.
"""
