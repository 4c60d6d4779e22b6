"""The model DAG: staging -> enriched -> marts, and the refresh drivers around it."""
