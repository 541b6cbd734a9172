"""The served queries and the batch form of each job."""
