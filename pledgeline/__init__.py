"""Fundraising-pipeline analytics as lazy Spark DataFrame operators."""
