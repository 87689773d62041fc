"""reliefspark: Lidar point clouds and terrain meshes as Spark DataFrames."""
