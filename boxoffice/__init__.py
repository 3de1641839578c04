"""Ticket-sales analytics written as Spark DataFrame plans."""
