"""Practice analytics on Spark: answer cards in, statistics, scores, ranks and wide tables out."""
