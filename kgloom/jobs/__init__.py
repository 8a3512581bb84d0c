"""Source-to-graph jobs: each composes library operators into one Spark job."""
