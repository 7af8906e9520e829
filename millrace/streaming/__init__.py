"""Scheduled polling of new documents as a micro-batch query."""
