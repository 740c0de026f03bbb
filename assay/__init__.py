"""assay: data-assurance jobs (checks, diffs, manifests, corpus lint, run
reports, tenancy plans) expressed as Spark DataFrame plans.

Every public job takes DataFrames and returns a DataFrame; nothing but result
rows leaves the executors.
"""

__version__ = "0.1.0"
