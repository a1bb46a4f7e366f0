"""Measures and checks of building-model fleets, and the evidence about them, as Spark DataFrame operators."""
