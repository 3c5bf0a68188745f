"""quireline: analytics over scanned-document collections, planned by Spark."""
