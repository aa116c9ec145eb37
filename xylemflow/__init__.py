"""Sensor-observation analytics on Spark: raw logger text to quality-checked sap-flow tables."""
