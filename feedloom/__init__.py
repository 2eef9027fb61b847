"""feedloom: user-item feedback tables built as Spark DataFrame jobs.

Raw ratings/reviews and product metadata go in; checked, model-ready
tables come out (clean interactions, items, labels, integer indices,
profiles, validation findings and exploratory summaries).  Every step is a
DataFrame/SQL expression so Catalyst plans it and the cluster runs it.
"""

__version__ = "0.1.0"
