"""quern: data governance and evaluation for labelled, grouped data, as Spark jobs."""
