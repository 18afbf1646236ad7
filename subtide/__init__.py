"""Subscription-lifecycle analytics as lazy Spark plans."""
