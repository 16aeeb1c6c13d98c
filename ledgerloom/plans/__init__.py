"""Business measures, dashboard reports and load plans built from the operators."""
