"""All registered queries and their SQL, one module per group of operators."""

from fadecast.catalog import cleaning, models, ordering, scoring, timeseries

MODULES = (cleaning, scoring, ordering, timeseries, models)
