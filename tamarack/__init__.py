"""Company-sourcing analytics and training-data operators on Spark."""
