"""The indicator tables users ask for, composed from the operators."""
