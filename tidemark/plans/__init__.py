"""The datasets: cleaned tables, marts, serving and exploratory queries."""
