"""Parcel-logistics finance and operations marts as Spark DataFrame pipelines."""
