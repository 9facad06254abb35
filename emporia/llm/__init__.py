"""Operators for preparing training corpora, each as a Spark job over whole tables."""
