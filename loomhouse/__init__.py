"""Warehouse modelling on Spark: normal forms, SCD Type 2 history and Data Vault loads."""
