"""Comparative-genomics analytics and corpus operators, declared as Spark DataFrame plans."""
