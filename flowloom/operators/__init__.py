"""DataFrame-to-DataFrame steps of the dataset build and of evaluation."""
