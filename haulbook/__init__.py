"""Delivery-network analytics on Spark: scorecards and CRM-ready tables as DataFrame pipelines."""
